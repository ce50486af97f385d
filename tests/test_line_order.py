"""Line numbers over files and splits, and rows and rejects of a stream read once."""

import os

import pytest
from pyspark.sql import functions as F

from behavio.sources import read_lines
from behavio.sources.numbering import numbered, positioned, split_offsets
from behavio.streaming.lines import run_lines
from behavio.streaming.runner import read_table

H = 1511658000


def _line(i):
    return f"{i},10.0.0.1,fail,{H + i}" if i % 7 else f"{i},bad"


def _write(folder, name, numbers, stamp=None, end="\n"):
    path = folder / name
    path.write_text("\n".join(map(_line, numbers)) + end)
    if stamp:
        os.utime(path, (stamp, stamp))


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_numbers_follow_files_and_splits(spark, tmp_path, small_splits):
    # files of other sizes, so that Spark packs the splits in another order
    for name, a, b in (("a", 0, 50), ("b", 50, 1500), ("c", 1500, 1510), ("d", 1510, 2400)):
        _write(tmp_path, name, range(a, b), end="" if name == "b" else "\n")
    lines = positioned(spark.read.text(str(tmp_path)))
    splits = split_offsets(lines, ranges=5).orderBy("path", "start").collect()
    assert len(splits) > 20 and [s.before for s in splits] == [sum(x.n for x in splits[:i]) for i in range(len(splits))]
    got = numbered(lines).collect()
    assert sorted((r.line_no, r.value) for r in got) == [(i, _line(i)) for i in range(2400)]
    rows, rejects = read_lines(spark, str(tmp_path), "login", on_error="reject", in_order=True)
    assert [(r.seq, r.user_id) for r in rows.orderBy("seq").collect()] == [(i, i) for i in range(2400) if i % 7]
    assert [r.seq for r in rejects.orderBy("seq").collect()] == list(range(0, 2400, 7))


def test_equal_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "a").write_text("")
    (tmp_path / "b").write_text("x\nx\n\nx")
    assert [(r.line_no, r.value) for r in numbered(positioned(spark.read.text(str(tmp_path)))).orderBy("line_no").collect()] == [
        (0, "x"), (1, "x"), (2, ""), (3, "x")]
    (tmp_path / "b").write_text("")
    assert numbered(positioned(spark.read.text(str(tmp_path)))).count() == 0


def test_text_that_changes_raises(spark, tmp_path):
    _write(tmp_path, "a", range(10))
    rows = numbered(positioned(spark.read.text(str(tmp_path))))
    # more lines in as many bytes than the first pass has counted
    (tmp_path / "a").write_text("\n" * (tmp_path / "a").stat().st_size)
    with pytest.raises(Exception, match="text changed while its lines were numbered"):
        rows.collect()


def test_streams_are_not_numbered_by_read_lines(spark, tmp_path):
    with pytest.raises(ValueError):
        read_lines(spark, str(tmp_path), "login", streaming=True, in_order=True)


def test_stream_keeps_rows_and_rejects_in_arrival_order(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    # z arrives first
    _write(folder, "z", range(0, 20), 1_700_000_000)
    _write(folder, "a", range(20, 30), 1_700_000_100)
    rows, rejects = run_lines(spark, str(folder), "login", base=base, max_files=1)
    first = sorted((r.seq, r.user_id) for r in rows.collect())
    assert first == [(i, i) for i in range(30) if i % 7]
    assert sorted((r.seq, r.line) for r in rejects.collect()) == [(i, _line(i)) for i in range(0, 30, 7)]
    _write(folder, "m", range(30, 45), 1_700_000_200)
    rows, rejects = run_lines(spark, str(folder), "login", base=base, max_files=1)
    assert sorted((r.seq, r.user_id) for r in rows.collect()) == [(i, i) for i in range(45) if i % 7]
    # one row group of files per micro-batch, rows and rejects beside each other
    assert sorted(os.listdir(f"{base}/data")) == [f"microbatch={i}" for i in range(3)]
    assert {n for n in os.listdir(f"{base}/data/microbatch=0") if n.startswith("bad=")} == {"bad=false", "bad=true"}
    table = read_table(spark, f"{base}/data", "path string, microbatch long, bad boolean")
    assert [r["count"] for r in table.groupBy("microbatch").count().orderBy("microbatch").collect()] == [20, 10, 15]


def test_stream_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows, rejects = run_lines(spark, str(tmp_path / "in"), "login")
    assert rows.columns == ["user_id", "ip", "event_type", "ts", "seq"] and rows.count() == 0 and rejects.count() == 0


def test_stream_reads_each_file_once(spark, tmp_path):
    from behavio.streaming import lines as module
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder, "a", range(40))
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(v):
        reads.add(1)
        return v
    parse = module.parse_lines
    module.parse_lines = lambda ls, layout, seq: parse(ls.withColumn("value", seen("value")), layout, seq=seq)
    try:
        rows, rejects = run_lines(spark, str(folder), "login")
        rows.collect(), rejects.collect()
    finally:
        module.parse_lines = parse
    assert reads.value == 40
