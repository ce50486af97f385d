"""The Merkle manifest against a tree built node by node."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from behavio.llm import merkle
from llm_data import EDGES, corpus


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        j = i ^ 1
        out.append("" if j >= len(nodes) else ("L" if j < i else "R") + nodes[j])
        i >>= 1
    return out


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """rows (id, tree, leaf, claimed) -> sorted (id, tree, leaf, subroot, root, proof, folded)."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3] or r[2])):
        trees.setdefault(r[1], []).append(r)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    grown = {n: levels_of([r[2] for r in trees[n]]) for n in names}
    top = levels_of([grown[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for i, r in enumerate(trees[n]):
            proof, h = path_of(grown[n], i) + path_of(top, k), r[3] or r[2]
            for s in proof:
                h = digest(s[1:], h) if s[:1] == "L" else digest(h, s[1:])
            out.append((r[0], n, r[2], grown[n][-1][0], top[-1][0], tuple(proof), h))
    return sorted(out, key=repr)


def spark_rows(spark, rows, band):
    df = spark.createDataFrame(rows, "id long, lang string, leaf string, claimed string")
    df = df.selectExpr("*", *[f"CAST(NULL AS string) AS `{c}`" for c in ("tree", "lo", "hi", "rest", "ends", "rank", "n", "item", "_at")])
    found = merkle.manifest(df, tree="lang", order="id", leaf="leaf", claimed="claimed", band=band).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in found)
    return sorted(((r.id, r.lang, r.leaf, r.subroot, r.root, tuple(r.proof), r.folded_root) for r in found), key=repr)


@pytest.mark.parametrize("band", [1, 2, 10])
def test_proofs_like_a_tree_built_by_hand(spark, band):
    rnd = random.Random(band)
    rows = []
    for lang, n in (("en", 37), ("de", 16), (None, 5), ("fr", 1), ("", 3), ("Ä", 2), ("zz", 8)):
        for _ in range(n):
            i = rnd.choice([None, *range(500)])
            leaf = digest(str((lang, i, rnd.random())))
            rows.append((i, lang, leaf, digest(leaf) if rnd.random() < 0.2 else None))
    rows += [rows[0]] * 3 + [(7, "en", digest("x"), None)] * 2
    assert spark_rows(spark, rows, band) == brute(rows)


def test_one_leaf_is_its_root(spark):
    leaf = digest("only")
    assert spark_rows(spark, [(1, "en", leaf, None)], 10) == [(1, "en", leaf, leaf, leaf, (), leaf)]


def test_many_equal_rows_are_leaves_each(spark):
    rows = [(None, "en", digest("same"), None)] * (merkle.COPIES + 5) + [(1, "en", digest("other"), None)]
    found = spark_rows(spark, rows, 10)
    assert found == brute(rows)


def test_empty_table(spark):
    assert spark_rows(spark, [], 10) == []


def test_leaves_of_edge_texts(spark):
    rows = [(i, t, None if i == 3 else len(t or "")) for i, t in EDGES + corpus(3, 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = df.select("doc_id", "text", "n_chars", merkle.leaf_digest(F.col("doc_id"), F.col("n_chars"), F.col("text")).alias("d")).collect()
    assert all(r.d == digest(field(r.doc_id), field(r.n_chars), field(r.text)) for r in got)


def test_nodes_carry_the_leaf_ranks_they_cover(spark):
    leaves = [digest(str(i)) for i in range(11)]
    nodes = spark.createDataFrame([("t", i, 11, d, None) for i, d in enumerate(leaves)], "tree string, lo long, leaves long, digest string, item string")
    bands = merkle.grown(nodes, 2, "test")
    got = {(r.level, r.lo): (r.hi, r.digest) for r in merkle.labelled_nodes(bands, 2).collect()}
    want = {(k, i << k): (min((i + 1) << k, 11), d) for k, level in enumerate(levels_of(leaves)) for i, d in enumerate(level)}
    assert got == want
