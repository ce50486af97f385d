"""Substring, suffix and exact deduplication against brute force."""

import hashlib
import random
import re

import pytest

from behavio.llm import exact_dedup, shared_runs, substring_dedup, suffix_dedup
from llm_data import EDGES, corpus, frame

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def order(rows):
    return [(LAST if i is None else i, (t or "").encode()) for i, t in rows]


def words_kept(rows, width):
    first, out = {}, {}
    for i, t in order(rows):
        w = WORDS.findall(t)
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, LAST), i)
    for i, t in order(rows):
        w = WORDS.findall(t)
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def bytes_kept(rows, width):
    first, out = {}, {}
    for i, t in order(rows):
        for k in range(len(t) - width + 1):
            key = t[k:k + width]
            first[key] = min(first.get(key, (LAST, LAST)), (i, k))
    for i, t in order(rows):
        gone = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if first[t[k:k + width]] < (i, k):
                gone[k:k + width] = b"\1" * width
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(t), sum(gone), runs, bytes(x for x, g in zip(t, gone) if not g))
    return out


@pytest.mark.parametrize("rows,width", [(corpus(1), 13), (corpus(2), 5), (corpus(3), 2), (EDGES[:-1], 13), ([], 13)])
def test_substrings(spark, rows, width):
    got = substring_dedup.remove_repeats(frame(spark, rows), width=width, shard_bytes=2000).collect()
    exp = words_kept(rows, width)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.text) == exp[LAST if r.doc_id is None else r.doc_id]
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


@pytest.mark.parametrize("rows,width", [(corpus(4), 100), (corpus(5), 30), (corpus(6), 9), (EDGES[:8] + EDGES[9:-1], 100), ([], 100)])
def test_byte_strings(spark, rows, width):
    rows = [(i, t[:6000] if t else t) for i, t in rows]  # the brute force holds every window
    got = suffix_dedup.remove_repeats(frame(spark, rows), width=width, shard_bytes=5000).collect()
    exp = bytes_kept(rows, width)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == exp[LAST if r.doc_id is None else r.doc_id]


def test_every_repeat_in_the_first_document(spark, monkeypatch):
    from behavio.llm import shared_runs
    rnd = random.Random(12)
    words = lambda k: [f"w{rnd.randrange(10 ** 6)}" for _ in range(k)]
    rows = []
    for k in range(0, 60, 3):
        p, q = words(30), words(20)
        rows += [(k, " ".join(p + words(20))), (k + 1, " ".join(p + q + words(25) + p + q + words(9) + p + q))]
    exp = words_kept(rows, 13)
    for classes in (shared_runs.HOT_CLASSES, 0):  # also with every window dealt alone
        monkeypatch.setattr(shared_runs, "HOT_CLASSES", classes)
        assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame(spark, rows), width=13).collect()} == exp


def shared_ids(rnd):
    """Rows of null and equal ids and different texts, with passages that others have."""
    words = lambda k: [f"w{rnd.randrange(10 ** 6)}" for _ in range(k)]
    p, q = words(40), words(35)
    texts = [words(9) + p + words(9), words(3) + q, words(50), p + words(20), words(30) + q + words(2) + p[:30], p + words(20), q + words(5),
             words(9) + p + q, p[:25] + words(8)]
    ids = [1, 7, 7, 7, 7, None, None, None, None]
    return [(i, " ".join(t)) for i, t in zip(ids, texts)] + [(None, None)]


def test_rows_that_share_an_id_keep_their_own_text(spark):
    rows = shared_ids(random.Random(21))
    first = {}
    for i, t in order(rows):
        w = WORDS.findall(t)
        for k in range(len(w) - 12):
            first[tuple(w[k:k + 13])] = min(first.get(tuple(w[k:k + 13]), LAST), i)
    exp = []
    for i, t in order(rows):
        w = WORDS.findall(t)
        gone = {x for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < i for x in range(k, k + 13)}
        exp.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    got = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((LAST if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == sorted(exp)
    first, exp = {}, []
    for i, t in order(rows):
        for k in range(len(t) - 99):
            first[t[k:k + 100]] = min(first.get(t[k:k + 100], (LAST, LAST)), (i, k))
    for i, t in order(rows):
        gone = {x for k in range(len(t) - 99) if first[t[k:k + 100]] < (i, k) for x in range(k, k + 100)}
        exp.append((i, len(t), len(gone), bytes(x for k, x in enumerate(t) if k not in gone)))
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == sorted(exp)


def test_only_anchors_are_shuffled_to_find_those_that_recur(spark, monkeypatch):
    """Of runs without a partner nothing but the anchor goes through a shuffle, and runs of one class are not joined with anchors."""
    made, kept = {}, shared_runs.written

    def keep(df, name):
        got = kept(df, name)
        made[name] = got.inputFiles()
        return got
    monkeypatch.setattr(shared_runs, "written", keep)
    rows = corpus(21, 60)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == {i: v[1] for i, v in bytes_kept(rows, 100).items()}
    assert spark.read.parquet(*made["anchors"]).columns == ["fp"]
    runs = spark.read.parquet(*made["runs"])
    assert runs.count() and not runs.groupBy("fp").count().where("count = 1").count()


@pytest.mark.parametrize("operator,width", [(substring_dedup, 13), (suffix_dedup, 100)])
def test_short_grams_that_recur_by_chance_are_done_with_at_once(spark, monkeypatch, operator, width):
    """Few different words: nearly each 5-gram recurs, but no window does, so no run goes on (but for one copied passage)."""
    made, kept = {}, shared_runs.written

    def keep(df, name):
        got = kept(df, name)
        made[name] = got.inputFiles()
        return got
    monkeypatch.setattr(shared_runs, "written", keep)
    rnd = random.Random(22)
    names = ["alpha", "bravo", "delta", "gamma", "kappa", "omega"]
    rows = [(i, " ".join(rnd.choices(names, k=120))) for i in range(150)]
    rows.append((150, " ".join(rows[7][1].split()[30:60])))
    got = {r.doc_id: r.n_removed for r in operator.remove_repeats(frame(spark, rows)).collect()}
    assert got == {i: v[1] for i, v in (words_kept if operator is substring_dedup else bytes_kept)(rows, width).items()}
    assert got[150] > 13
    assert 0 < spark.read.parquet(*made["runs"]).count() < 300  # of some thousand


def test_hot_anchors_are_split(spark, monkeypatch):
    from behavio.llm import shared_runs
    monkeypatch.setattr(shared_runs, "HOT_CLASSES", 2)
    rnd = random.Random(9)
    line = " ".join(f"c{i}" for i in range(20))
    rows = [(i, f"{' '.join(f'u{rnd.randrange(900)}' for _ in range(9))} {line} {' '.join(f'u{rnd.randrange(900)}' for _ in range(9))}")
            for i in range(60)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame(spark, rows), width=13).collect()}
    assert got == words_kept(rows, 13)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))
           for r in suffix_dedup.remove_repeats(frame(spark, rows), width=40).collect()}
    assert got == bytes_kept(rows, 40)


def test_equal_windows_of_hot_anchors_do_not_gather(spark, monkeypatch):
    from behavio.llm import shared_runs

    def none(*_):
        def run(frames):
            for frame in frames:
                assert not frame.num_rows
                yield frame.select(["doc_id", "row", "pos", "n", "run"])
        return run
    monkeypatch.setattr(shared_runs, "HOT_CLASSES", 0)
    monkeypatch.setattr(substring_dedup, "decider", none)
    rnd = random.Random(10)
    line = " ".join(f"c{i}" for i in range(20))
    rows = [(i, f"{line} {' '.join(f'u{rnd.randrange(900)}' for _ in range(9))}") for i in range(60)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame(spark, rows), width=13).collect()}
    assert got == words_kept(rows, 13)


def test_shuffling_joins_give_the_same(spark, monkeypatch):
    from behavio.llm import shared_runs
    monkeypatch.setattr(shared_runs, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(shared_runs, "BROADCAST_ROWS", 0)
    rows = corpus(7)
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame(spark, rows), width=13).collect()}
    assert got == words_kept(rows, 13)


def test_automaton_matching_statistics():
    rnd = random.Random(2)
    for _ in range(200):
        seqs = [[rnd.randrange(3) for _ in range(rnd.randrange(0, 9))] for _ in range(4)]
        a = substring_dedup.Automaton()
        for s in seqs:
            a.add(s)
        inside = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i, len(s) + 1)}
        q = [rnd.randrange(4) for _ in range(12)]
        exp = [max(n for n in range(k + 2) if tuple(q[k + 1 - n:k + 1]) in inside or n == 0) for k in range(len(q))]
        assert list(a.matches(q)) == exp


def test_deep_shallow_order():
    import numpy as np
    rnd = random.Random(3)
    data = bytes(rnd.choice(b"ab") for _ in range(600)) + b"ab" * 100
    at = np.arange(len(data) - 60)
    got = list(suffix_dedup.equal_windows(data, at, 60, 16))
    groups = {}
    for k in at.tolist():
        groups.setdefault(data[k:k + 60], []).append(k)
    exp = [sorted(v) for _, v in sorted(groups.items()) if len(v) > 1]
    assert [sorted(g) for g in got] == exp  # sets of equal windows, in suffix order


@pytest.mark.parametrize("rows", [corpus(8), EDGES + [(20, "a b"), (21, " a  b"), (22, "a\tb"), (23, "a b ")], []])
def test_exact_groups(spark, rows):
    got = exact_dedup.exact_groups(frame(spark, rows)).collect()
    norm = [(LAST if i is None else i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    assert len(got) == len(rows)
    for r in got:
        mine = [t for i, t in norm if i == (LAST if r.doc_id is None else r.doc_id)
                and hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        same = [i for i, t in norm if t == mine[0]]
        keep = min(same)
        assert r.group_size == len(same) and (LAST if r.keep_id is None else r.keep_id) == keep
        assert r.kept == (r.doc_id == r.keep_id)


def test_chunks_join_to_the_text_and_depend_on_nearby_words_only(spark):
    from pyspark.sql import functions as F
    rows = corpus(9) + [(2000, "y" * 5000 + "  z "), (2001, "")]
    df = frame(spark, rows, False).select("doc_id", "text", exact_dedup.chunks(F.col("text")).alias("c"))
    for r in df.collect():
        assert "".join(r.c) == r.text and all(r.c)
    base = " ".join(f"t{i * 31 % 977}" for i in range(2000))
    a, b = (x.c for x in spark.createDataFrame([(base,), ("new words first " + base,)], "text string").select(
        exact_dedup.chunks(F.col("text")).alias("c")).collect())
    assert len(set(a) - set(b)) <= 1 < len(a)


def test_a_forged_identifier_does_not_join_texts(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup, "identifier", lambda c: F.unhex(F.lit("00")) if False else F.substring(F.md5(c.cast("binary")), 1, 1))
    rows = corpus(10)
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(frame(spark, rows)).collect()}
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in rows}
    assert got == {i: min(j for j in norm if norm[j] == norm[i]) for i in norm}
