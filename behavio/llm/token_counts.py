"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokens) below one folder for each tokenizer version, which is a
digest too: of the vocabulary file, its library and the library's version.  The digests of all rows are
joined to it; of the distinct texts that it lacks, one row each is encoded, and their counts are
appended.  Only digests (32 bytes) are grouped and joined; a text moves only if more than
``BROADCAST_KEYS`` distinct texts are missing at once.

A run's counts are appended as a folder of its own by Spark's commit protocol.  Two runs at once may
append the same digests, with equal counts; readers take one of them."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from behavio.session import scratch_path

from .common import written
from .shared_runs import small
from .token_parts import parts_of, word_ids

STORED = "digest binary, n_tokens long"
#: Rows (32-byte digest and count) of a broadcast.
BROADCAST_COUNTS = 500_000
#: Parts and digests that a task remembers at most.
MOST_PARTS, MOST_SEEN = 300_000, 300_000


def library_of(path: str) -> str:
    """Name and version of the library that reads a tokenizer file."""
    from importlib.metadata import version
    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    return f"{name} {version(name)}"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(hashlib.sha256(f.read()).hexdigest().encode() + library_of(path).encode()).hexdigest()


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens, as the file's library gives them without added tokens.

    The texts of a byte-level BPE are counted by parts (see ``token_parts``) between special strings, others whole."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    words = word_ids(path)
    plain = all(re.fullmatch(r"[!-~]+", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
    if words.by_rank is None or not plain:
        return lambda texts: [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    # leftmost, then longest, as the library takes them
    special = re.compile("|".join(re.escape(t) for t in sorted((t["content"] for t in added), key=len, reverse=True)) or "(?!)")
    known: dict[str, int] = {}

    def of_word(word: str) -> int:
        n = known.get(word)
        if n is None:
            n = known[word] = len(words[word]) // 4
        return n

    def count(text: str) -> int:
        between = special.split(text) if special.search(text) else [text]
        total = len(between) - 1
        for piece in between:
            if piece:
                first, *rest = parts_of(piece)
                total += len(words.slow(first)) // 4 + sum(map(of_word, rest))
        if len(known) > MOST_PARTS:
            known.clear()
        words.clear()
        return total
    return lambda texts: [count(t) for t in texts]


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cache of one tokenizer version; a digest may be there more than once."""
    at = f"{cache.rstrip('/')}/version={version}"
    if not _exists(spark, at):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(at)


def _encoded(rows: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of rows of (digest, text); a digest that a task has met is not encoded again."""
    def run(batches):
        import pyarrow as pa
        count, seen = counter(path), set()
        for batch in batches:
            new = {d: t for d, t in zip(batch["digest"].to_pylist(), batch["text"].to_pylist()) if d not in seen}
            seen = seen | new.keys() if len(seen) < MOST_SEEN else set(new)
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), pa.array(count(list(new.values())), pa.int64())], ["digest", "n_tokens"])
    return rows.select("digest", "text").mapInArrow(run, STORED)


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str | None = None, *, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``digest`` (sha256 of the text), ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens).  Counts are read from and appended to the folder ``cache``, which many
    runs and tokenizers may share; without one, a new folder in the session's checkpoint folder is used.

    A null text counts as an empty one, and that normalisation alone leaves the count of any tokenizer as it is; an
    empty text is encoded like any other.  Every row has its row, also of equal ids or no id; equal texts are encoded once, but for
    rows of equal text and id, which may be once a task.  Texts are encoded whole, at any length.  Other columns
    are not read.  An empty table gives none and appends nothing."""
    spark = docs.sparkSession
    version, cache = tokenizer_version(tokenizer_path), (cache or scratch_path(spark, "token-cache")).rstrip("/")
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
            .withColumn("place", F.xxhash64("id", "digest")))
    digests = written(rows.select("id", "digest", "place", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    wanted = written(digests.groupBy("digest").agg(F.min("place").alias("place")), "wanted")
    before = stored(spark, cache, version).select("digest")
    misses = written(wanted.join(before, "digest", "left_anti").select("place"), "misses")
    if not misses.isEmpty():
        texts = rows.join(small(misses), "place", "left_semi")
        _encoded(texts, tokenizer_path).write.parquet(f"{cache}/version={version}/run={uuid.uuid4().hex}")
    known = stored(spark, cache, version).join(wanted.select("digest"), "digest", "left_semi")
    known = written(known.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "known")
    found = digests.join(small(known, BROADCAST_COUNTS), "digest", "left")
    n = F.coalesce("n_tokens", F.raise_error(F.lit("a text changed between two reads of the table")).cast("long"))
    return found.select(F.col("id").alias(id_col), "digest", "n_bytes", n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
