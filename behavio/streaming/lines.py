"""Text lines of a stream as typed rows and rejects (P8), read once.

A micro-batch is parsed once and written with one job that lays rows and
rejects into two folders of the micro-batch; both appear by the job's commit, and a
micro-batch run again replaces both.  Each line keeps its file, the first byte of
its split and its place there, so lines are numbered afterwards from the
written tables without reading the text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..sources.lines import LAYOUTS, Layout, parse_lines
from ..sources.numbering import numbered, source_split
from .runner import fold_available, read_table
from .sources import MAX_FILES

#: Input order of a growing folder: files of an earlier micro-batch come first, then by path.  Numbers given once stay.
ARRIVAL = ("microbatch", "path", "start")
#: Input order of a folder that is complete, as a batch read has it.
BY_PATH = ("path", "start")


def run_lines(spark: SparkSession, folder: str, layout: str | Layout, *, order: tuple[str, ...] = ARRIVAL, base: str | None = None,
              max_files: int = MAX_FILES) -> tuple[DataFrame, DataFrame]:
    """The lines of the folder's files as (rows, rejects), all those available now.

    rows: the layout's fields and ``seq``; rejects: ``line`` and ``seq``.  ``seq`` numbers good and bad lines together from 0 in
    ``order``.  Called again with the same ``base``, the query goes on with new files; numbers in
    ``ARRIVAL`` order never change.  A folder without files gives two empty tables."""
    base = (base or scratch_path(spark, "lines")).rstrip("/")
    fields = [n for n, _, _ in (LAYOUTS[layout] if isinstance(layout, str) else layout).fields]

    def parsed(lines: DataFrame) -> DataFrame:
        # the rejects' fields are not kept
        typed = parse_lines(lines, layout, seq="where")
        kept = [F.when(F.col("_ok"), F.col(n)).alias(n) for n in fields]
        return typed.select("seq.*", *kept, F.when(~F.col("_ok"), F.col("_line")).alias("line"), (~F.col("_ok")).alias("bad"))

    def stream(own: SparkSession) -> DataFrame:
        lines = source_split(own.readStream.option("maxFilesPerTrigger", max_files).text(folder))
        return lines.select("value", "path", "start")

    def fold(batch: DataFrame, batch_id: int) -> None:
        place = F.struct("path", "start", F.monotonically_increasing_id().alias("at"))
        (parsed(batch.select("value", place.alias("where"))).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("bad").parquet(f"{base}/data/microbatch={batch_id}"))

    fold_available(spark, stream, base, fold, "lines")
    empty = spark.createDataFrame([], "value string, path string, start long, at long")
    schema = parsed(empty.select("value", F.struct("path", "start", "at").alias("where"))).schema
    kept = StructType([*schema.fields]).add("microbatch", "long")
    out = numbered(read_table(spark, f"{base}/data", kept), order, "seq")
    return out.where("NOT bad").select(*fields, "seq"), out.where("bad").select("line", "seq")
