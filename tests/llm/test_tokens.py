"""Token counts and tokenizer alignment against the libraries on whole texts."""

import glob
import random
from collections import Counter

import numpy as np
import pytest

from behavio.llm import alignment, token_counts
from behavio.llm.catalogue import tokenizer_path
from llm_data import EDGES, corpus, frame

ODD = ["x▁y blank", "a  b", "  lead", "trail  ", " ", "\n", "a \n b", "a b c", "tab\tand \t blank", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
       "<s>hi</s> <unk> <0x0A>", "it's 'tis we'll n't", "１２ 34 ５", "é ﬁ ½", "​ zero ﻿width", "\x00 nul \x1c sep", "日本語 テキスト 漢字", "🙂 🙂🙂 a",
       "x" * 3000 + " " + "é" * 500, "a b   c", "कि ता ब", "¡Hola! ¿qué?", "1,000.50 $5 50%", "CamelCase snake_case", "　 wide 　"]


def random_texts(seed, n):
    rnd = random.Random(seed)
    letters = "ab cd  ef\n\t'.,!1 2é漢▁<|>s ́"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 60))) for _ in range(n)]


def rows_of(seed=1):
    texts = ODD + random_texts(seed, 300) + [t for _, t in corpus(seed, 40)]
    return EDGES + [(100 + i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def brute_alignment(rows, libraries):
    a_lib, b_lib = libraries
    spelt_a, spelt_b = alignment.byte_spellings(tokenizer_path()), alignment.piece_spellings(b_lib)
    docs, pairs = [], Counter()
    for i, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if b"".join(spelt_a[x] for x in a) != want or b"".join(spelt_b[x] for x in b) != want:
            a, b = [], []
        linked, groups, at_a, at_b, p, q = [], [], 0, 0, 0, 0
        own_a, own_b = [], []
        while p < len(a) or q < len(b):  # the token that ends first goes next
            if q >= len(b) or p < len(a) and at_a + len(spelt_a[a[p]]) <= at_b + len(spelt_b[b[q]]):
                at_a += len(spelt_a[a[p]])
                own_a.append(a[p])
                p += 1
            else:
                at_b += len(spelt_b[b[q]])
                own_b.append(b[q])
                q += 1
            if at_a == at_b:
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                x = 0
                for m in own_a:
                    y = 0
                    for n in own_b:
                        if x < y + len(spelt_b[n]) and y < x + len(spelt_a[m]):
                            linked.append((m, n))
                        y += len(spelt_b[n])
                    x += len(spelt_a[m])
                own_a, own_b = [], []
        pairs.update(linked)
        docs.append((i, len(a), len(b), len(groups), linked, ";".join(groups)))
    most = {}
    for (_, b), n in pairs.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(((i, na, nb, ng, len(l), sum(pairs[x] == most[x[1]] for x in l), sum(pairs[x] for x in l), g) for i, na, nb, ng, l, g in docs), key=repr)


def aligned(df, **options):
    found = alignment.align(df, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), **options).collect()
    return sorted((tuple(r) for r in found), key=repr)


@pytest.mark.parametrize("options", [{}, {"broadcast_pairs": 10}])
def test_alignment_of_edge_texts(spark, libraries, options):
    rows = rows_of()
    assert aligned(frame(spark, rows), **options) == brute_alignment(rows, libraries)


def test_alignment_of_the_given_documents(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert aligned(docs) == brute_alignment(rows, libraries)


def test_alignment_with_small_slices_and_memory(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_CHARS", 300)
    monkeypatch.setattr(alignment, "MOST_PARTS", 20)
    rows = rows_of(2)
    assert aligned(frame(spark, rows)) == brute_alignment(rows, libraries)


def test_alignment_of_an_empty_table(spark):
    assert aligned(frame(spark, [])) == []


def test_pointers_meet_at_each_groups_last_token():
    rnd = random.Random(5)
    for _ in range(200):
        size = rnd.randrange(1, 80)
        cut = lambda: np.array(sorted({*rnd.sample(range(1, size + 1), rnd.randrange(0, size)), size}))
        a, b = cut(), cut()
        of_a, of_b = alignment.labels(a, b)
        ends = sorted(set(a.tolist()) & set(b.tolist()))
        last = lambda e: b.tolist().index(next(x for x in ends if x >= e))
        assert of_a.tolist() == [last(e) for e in a] and of_b.tolist() == [last(e) for e in b]


def appended(cache):
    return len(glob.glob(f"{cache}/version=*/run=*"))


def counts(df, cache, path=None, limit=30):
    found = token_counts.token_counts(df, path or tokenizer_path(), cache, limit=limit).drop("digest").collect()
    return sorted((tuple(r) for r in found), key=repr)


def brute_counts(rows, path=None, limit=30):
    from tokenizers import Tokenizer
    if path and path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lambda t: len(model.encode(t))
    else:
        library = Tokenizer.from_file(path or tokenizer_path())
        size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    return sorted(((i, len((t or "").encode()), size(t or ""), size(t or "") > limit) for i, t in rows), key=repr)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_like_the_library_on_whole_texts(spark, tmp_path, name):
    rows = rows_of(3)
    assert counts(frame(spark, rows), str(tmp_path), tokenizer_path(name)) == brute_counts(rows, tokenizer_path(name))


def test_cache_encodes_each_missing_text_once(spark, tmp_path):
    cache, rows = str(tmp_path / "cache"), rows_of(4)
    first, rest = rows[:200], rows[150:]
    assert counts(frame(spark, first), cache) == brute_counts(first)
    version = token_counts.tokenizer_version(tokenizer_path())
    held = token_counts.stored(spark, cache, version)
    texts = len({t or "" for _, t in first})
    # the two rows of equal id and text may be encoded by two tasks
    assert held.select("digest").distinct().count() == texts and held.count() <= texts + 1
    assert counts(frame(spark, rest), cache) == brute_counts(rest)
    assert token_counts.stored(spark, cache, version).select("digest").distinct().count() == len({t or "" for _, t in rows})
    # nothing is missing: nothing is appended
    assert counts(frame(spark, rows), cache) == brute_counts(rows) and appended(cache) == 2
    # another tokenizer has counts of its own
    counts(frame(spark, rows), cache, tokenizer_path("piece_bpe_32k.model"))
    assert appended(cache) == 3


def test_stored_counts_are_used_and_may_be_there_twice(spark, tmp_path):
    cache, rows = str(tmp_path / "cache"), [(1, "one two"), (2, "three")]
    counts(frame(spark, rows), cache)
    at = f"{cache}/version={token_counts.tokenizer_version(tokenizer_path())}"
    spark.read.schema(token_counts.STORED).option("recursiveFileLookup", "true").parquet(at).write.parquet(f"{at}/run=again")
    assert counts(frame(spark, rows), cache) == brute_counts(rows)
    held = spark.createDataFrame([(r.digest, 77) for r in token_counts.stored(spark, cache, at.rpartition("=")[2]).distinct().collect()], token_counts.STORED)
    held.write.parquet(f"{tmp_path}/other/{at.rpartition('/')[2]}/run=x")
    assert {r[2] for r in counts(frame(spark, rows), f"{tmp_path}/other")} == {77}


def test_counts_of_an_empty_table(spark, tmp_path):
    assert counts(frame(spark, []), str(tmp_path / "cache")) == [] and appended(str(tmp_path / "cache")) == 0
