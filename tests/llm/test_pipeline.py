"""The corpus pipeline on small tables, stage by stage against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_data import corpus
from test_models import junk
from test_pairs import contaminated, groups_of, sets_of


def write(spark, folder, docs, labels, bench):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(8)
    good, bad = junk(rnd)
    texts = [good() for _ in range(260)] + [bad() for _ in range(60)]
    texts += texts[:20] + ["  ".join(t.split(" ")) for t in texts[20:30]]              # copies
    texts += [" ".join(["Changed"] + t.split(" ")[1:]) for t in texts[30:60]]            # near copies
    item = " ".join(f"question{i}" for i in range(14)) + "."
    texts += [f"{good()} {item} {good()}" for _ in range(10)]
    rnd.shuffle(texts)
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs += [(2000, None, None, None, None), (2001, "", "en", "s", 0), (2002, docs[0][1], "en", "s", 1), (None, good(), "en", "s", 1),
             (2003, "Repeated row. With two sentences here.", "en", "s", 1), (2003, "Repeated row. With two sentences here.", "en", "s", 1)]
    labels = [(i, int("!!" not in t and "|" not in t and "%%%" not in t and len(set(t.split())) > 2), 0) for i, t, *_ in docs[:250]]
    folder = str(tmp_path_factory.mktemp("tables"))
    write(spark, folder, docs, labels, [(1, item), (2, None)])
    return folder, docs


def test_stages(spark, tables, tmp_path):
    folder, docs = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "decontamination", "packing"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.columns
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in now.collect()] if k < 5 else None
        stage(spark, now, folder).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        seen.append((name, before, now))
        if k < 4:
            assert now.columns == columns
    after = {name: [(r.doc_id, r.text) for r in df.collect()] for name, _, df in seen[:4]}
    inputs = {name: before for name, before, _ in seen}
    is_bad = lambda t: t is not None and ("!!" in t or " | " in t or "%%%" in t or (len(t.split()) > 20 and len(set(t.split())) == 1))
    kept = after["quality"]
    assert sum(is_bad(t) for _, t in kept) <= 3
    clean = [d for d in inputs["quality"] if not is_bad(d[1]) and d[1]]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    norm = lambda t: " ".join((t or "").split())
    least = {}
    for i, t in inputs["exact dedup"]:
        least[norm(t)] = min(least.get(norm(t), 1 << 62), 1 << 62 if i is None else i)
    assert sorted(after["exact dedup"], key=str) == sorted({(None if i == 1 << 62 else i, t) for i, t in inputs["exact dedup"]
                                                            for j in [1 << 62 if i is None else i] if least[norm(t)] == j}, key=str)
    rows = inputs["near dedup"]
    comp = groups_of(sets_of(rows), 80)
    last = (1 << 63) - 1
    assert sorted(after["near dedup"], key=str) == sorted([(i, t) for i, t in rows if comp[last if i is None else i] == (last if i is None else i)], key=str)
    assert len(after["near dedup"]) < len(rows)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = contaminated(inputs["decontamination"], bench, 10)
    assert sorted(after["decontamination"], key=str) == sorted([(i, t) for i, t in inputs["decontamination"] if not hit[i][1]], key=str)
    assert len(after["decontamination"]) < len(inputs["decontamination"])
    packed = seen[4][2]
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in inputs["packing"]}


def test_rows_that_share_an_id_go_their_own_ways(spark, tmp_path):
    rnd = random.Random(18)
    good, bad = junk(rnd)
    item = " ".join(f"question{i}" for i in range(14)) + "."
    texts = [good() + " " + good() for _ in range(6)]
    near = " ".join(["Changed"] + (texts[2] + " " + texts[3] + " " + texts[2]).split(" ")[1:])
    odd = [(None, texts[0]), (None, texts[1]), (None, f"{good()} {item}"), (None, bad()), (-5, texts[2] + " " + texts[3] + " " + texts[2]), (None, near),
           (-9, texts[4]), (-9, texts[5]), (-9, texts[5]), (-9, texts[5].replace(" ", "  ", 1))]
    docs = [(i, good() if i % 5 else bad()) for i in range(300)]
    rows = [(i, t, "en", "s", len(t)) for i, t in docs + odd]
    write(spark, str(tmp_path), rows, [(i, int(i % 5 > 0), 0) for i in range(300)], [(1, item)])
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    odd_rows = lambda df: sorted([(r.doc_id, r.text) for r in df.collect() if r.doc_id is None or r.doc_id < 0], key=str)
    now = corpus_pipeline.keep_good(spark, now, str(tmp_path))
    assert odd_rows(now) == sorted([r for r in odd if r != odd[3]], key=str)
    now = corpus_pipeline.drop_copies(spark, now, str(tmp_path))
    after = odd_rows(now)
    assert len(after) == 7 and {" ".join(t.split()) for _, t in after} == {" ".join(t.split()) for k, (_, t) in enumerate(odd) if k != 3}
    now = corpus_pipeline.drop_near_copies(spark, now, str(tmp_path))
    assert odd_rows(now) == [r for r in after if r[1] != near]
    now = corpus_pipeline.drop_benchmark(spark, now, str(tmp_path))
    assert odd_rows(now) == [r for r in after if r[1] != near and item not in r[1]]


def test_run_equals_the_stages(spark, tables):
    out = corpus_pipeline.run(spark, tables[0])
    assert {"doc_id", "sequence_id", "offset", "length", "ids"} <= set(out.columns) and out.count() > 0


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered(spark):
    import re

    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 11))


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op3_exact_dedup", "op5_decontam", "op8_jaccard_join"])
def test_sql_of_queries(spark, name):
    import __spark_entry__ as E
    from tools.compare import digest, duck
    sf = "/root/testdata/sf0.001"
    assert digest(E.queries()[name](spark, sf).toPandas()) == digest(duck(sf).execute(E.oracle_sql()[name]).df())
