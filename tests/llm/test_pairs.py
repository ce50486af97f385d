"""Jaccard join, decontamination and components against brute force."""

import random
import re

import numpy as np
import pytest

from behavio.llm import decontam, jaccard_join
from behavio.llm.components import components
from llm_data import EDGES, corpus, frame

LAST = (1 << 63) - 1
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(rows, k=5):
    out = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOW).split()
        out[LAST if i is None else i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    return out


def groups_of(sets, threshold):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("rows,threshold", [(corpus(11, 200), 80), (corpus(12, 200), 60), (corpus(13), 90), (EDGES, 80), ([], 80)])
def test_similar_groups(spark, rows, threshold):
    got = jaccard_join.similar_groups(frame(spark, rows), threshold=threshold).collect()
    sets = sets_of(rows)
    exp = groups_of(sets, threshold)
    assert len(got) == len(rows)
    for r in got:
        i = LAST if r.doc_id is None else r.doc_id
        if r.doc_id is not None:
            assert r.n_shingles == len(sets[i])
            assert r.component_id == exp[i]


def test_frequent_tokens_lose_no_link(spark, monkeypatch):
    """Everything frequent, everything hot: the pair index carries all links."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", 1)
    rnd = random.Random(4)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rnd.randrange(0, 5)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10_000)}"
        rows.append((i, " ".join(w[rnd.randrange(0, 6):])))
    rows += [(100 + i, " ".join(base[:60] + [f"q{i}_{j}" for j in range(60)])) for i in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(frame(spark, rows)).collect()}
    assert got == groups_of(sets_of(rows), 80)


def test_sketches_differ_in_no_more_bits_than_sets():
    sets = [jaccard_join.token_sets([t or ""], 5)[0] for _, t in corpus(14, 60)]
    edge = np.cumsum([0, *map(len, sets)])
    bits = jaccard_join.sketches(np.concatenate(sets), edge)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            differ = len(np.setxor1d(x, y))
            found = sum(int(v).bit_count() for v in (bits[i] ^ bits[j]).view(np.uint64))
            assert found <= differ and found % 2 == differ % 2


def test_unlike_sets_of_a_large_group_are_no_candidates(spark, monkeypatch):
    """Copies of one text, each with its own changes: they share most tokens, but few are similar."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", 1)
    made, kept = {}, jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name: made.setdefault(name, kept(df, name)))
    rnd = random.Random(9)
    base = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rnd.sample(range(200), rnd.randrange(1, 8)):
            w[at] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    sets = sets_of(rows)
    similar = sum(100 * len(x & y) >= 75 * len(x | y) for i, x in sets.items() for j, y in sets.items() if i < j)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(frame(spark, rows)).collect()}
    assert got == groups_of(sets, 80)
    assert made["across"].count() <= similar


def test_large_unlike_sets_are_no_candidates(spark, monkeypatch):
    """Long texts of passages that others have too: all tokens recur, but no two texts are similar unless made so."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", 1)
    made, kept = {}, jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name: made.setdefault(name, kept(df, name)))
    rnd = random.Random(19)
    passages = [" ".join(f"p{i}_{j}" for j in range(250)) for i in range(24)]
    rows = [(i, " ".join(rnd.sample(passages, rnd.choice([4, 8, 9])))) for i in range(40)]
    rows += [(100 + i, f"{rows[3 * i][1]} {' '.join(f'q{i}_{j}' for j in range(20 * i))}") for i in range(8)]
    sets = sets_of(rows)
    similar = sum(100 * len(x & y) >= 50 * len(x | y) for i, x in sets.items() for j, y in sets.items() if i < j)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(frame(spark, rows)).collect()}
    assert got == groups_of(sets, 80)
    assert made["across"].count() <= similar
    members = [tuple(sorted(r.m)) for r in made["open"].groupBy("key").agg({"doc_id": "collect_list"}).toDF("key", "m").collect()]
    assert len(members) == len(set(members))


def test_documents_that_meet_in_many_groups_are_a_pair_in_few(spark, monkeypatch):
    """Copies of one text with changes of their own: two of them share most of some 100 keys, but are not similar."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", 1000)
    counted, kept = {}, jaccard_join.written

    def count(df, name):
        if name == "across":
            df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
            counted["join"] = joined(df)
            df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        return kept(df, name)

    def joined(df):  # rows of the join, before equal pairs become one
        df._jdf.queryExecution().toRdd().count()
        node = [df._jdf.queryExecution().executedPlan()]
        while node:
            at = node.pop()
            if "Join" in at.nodeName():
                return at.metrics().apply("numOutputRows").value()
            node += [at.children().apply(i) for i in range(at.children().size())]
    monkeypatch.setattr(jaccard_join, "written", count)
    rnd = random.Random(23)
    base = [f"v{i}" for i in range(400)]
    rows = []
    for i in range(40):
        w = list(base)
        for at in rnd.sample(range(400), 5):
            w[at] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    sets = sets_of(rows)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(frame(spark, rows)).collect()}
    assert got == groups_of(sets, 80)
    assert 0 < counted["join"] <= 4 * len(rows) * (len(rows) - 1) // 2


def test_second_sketches_differ_in_no_more_bits_than_sets():
    rnd = np.random.default_rng(3)
    base = np.unique(rnd.integers(0, 1 << 63, 5000, np.uint64))
    sets = [np.unique(np.concatenate((base[:k], rnd.integers(0, 1 << 63, n - k, np.uint64)))) for k, n in ((0, 1023), (1000, 1100), (1000, 2100), (2000, 2040), (3000, 4200), (4990, 5000))]
    fine = jaccard_join.fine_sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert [0 if v is None else 64 * len(v) for v in fine] == [0, 1024, 2048, 1024, 4096, 4096]
    for x, p in zip(sets[1:], fine[1:]):
        for y, q in zip(sets[1:], fine[1:]):
            if len(p) == 2 * len(q):
                p = p[:len(q)] ^ p[len(q):]
            if len(p) == len(q):
                differ = len(np.setxor1d(x, y))
                found = sum(int(v).bit_count() for v in (p ^ q).view(np.uint64))
                assert found <= differ and found % 2 == differ % 2


@pytest.mark.parametrize("n,m,seed", [(60, 50, 1), (200, 150, 2), (5, 0, 3)])
def test_components(spark, n, m, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(500, 530)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_rows_that_share_an_id_are_judged_apart(spark):
    rnd = random.Random(5)
    text = lambda k: [f"w{rnd.randrange(10 ** 6)}" for _ in range(k)]
    a, b, c = text(60), text(60), text(60)
    rows = [(None, a), (None, b), (5, b + ["x"]), (5, c), (3, c + ["y"]), (9, text(50)), (9, text(50)), (9, a + ["z"])]
    got = sorted(((r.doc_id or 99), r.component_id) for r in jaccard_join.similar_groups(frame(spark, [(i, " ".join(t)) for i, t in rows])).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (9, 9), (9, 9), (9, 9), (99, 5), (99, 9)]
    bench = spark.createDataFrame([(1, " ".join(b[:12]))], "item_id long, text string")
    got = decontam.contamination(frame(spark, [(i, " ".join(t)) for i, t in rows]), bench).collect()
    assert sorted((r.doc_id or 99, r.n_words, r.n_hit) for r in got) == sorted((i or 99, len(t), 12 if t[:12] == b[:12] else 0) for i, t in rows)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def contaminated(docs, items, width):
    out = {}
    wins = [(str(i) if i is not None else "", tuple(w[k:k + min(width, len(w))])) for i, t in items if (w := words(t))
            for k in range(len(w) - min(width, len(w)) + 1)]
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, g in wins:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    ids.add(i)
        out.setdefault(d, (len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("width", [10, 4])
def test_contamination(spark, width):
    rnd = random.Random(width)
    docs = corpus(14) + [(5000 + k, f"ÀB Cd, {t[:200]} É-é") for k, (_, t) in enumerate(corpus(14)[:10])]
    items = [(k, " ".join(t.split()[a:a + rnd.randrange(1, 40)])) for k, (_, t) in enumerate(docs[:30]) for a in [rnd.randrange(0, 5)]]
    items += [(70, ""), (71, None), (72, "É"), (73, items[0][1]), (None, items[1][1]), (0, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS fp", "'x' AS gram", "2 AS doc_id")
    got = decontam.contamination(frame(spark, docs), bench, window=width).collect()
    exp = contaminated(docs, items, width)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, list(r.item_ids)) == exp[r.doc_id]


def test_contamination_edges(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "x" * 40), (2, "a row without an id"), (3, "Same same")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontam.contamination(frame(spark, EDGES), bench).collect()
    exp = contaminated([e for e in EDGES if e[0] is not None], [(1, "x" * 40), (2, "a row without an id"), (3, "Same same")], 10)
    assert len(got) == len(EDGES)
    assert all((r.n_words, r.n_hit, list(r.item_ids)) == exp[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.n_hit == 0 for r in decontam.contamination(frame(spark, EDGES), none).collect())
    assert decontam.contamination(frame(spark, []), bench).collect() == []
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)  # the joins that shuffle
    again = decontam.contamination(frame(spark, EDGES), bench).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_main_path_is_native(spark):
    """No Python in the plans of the operators that are to be native."""
    from behavio.llm import exact_dedup
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    for df in (exact_dedup.exact_groups(frame(spark, corpus(15))), decontam.contamination(frame(spark, corpus(15)), bench)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_rare_and_frequent_sets_link(spark, monkeypatch):
    """A set with a rare prefix and a similar one whose prefix reaches frequent tokens."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", 6)
    rnd = random.Random(14)
    rows = []
    for g in range(30):
        common = [f"c{j}" for j in range(rnd.randrange(0, 70))]
        own = [f"g{g}_{j}" for j in range(rnd.randrange(20, 60))]
        for _ in range(rnd.randrange(1, 9)):
            w = common + own
            for _ in range(rnd.randrange(0, 4)):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(10_000)}"
            rows.append((len(rows), " ".join(w)))
    for t in (60, 80):
        got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(frame(spark, rows), threshold=t).collect()}
        assert got == groups_of(sets_of(rows), t)
