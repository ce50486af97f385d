"""Near duplicates: exact Jaccard join of word-shingle sets.

Texts of equal sets are one class, and only its representative goes on.  Tokens
(shingles) are ordered rare before frequent and by hash within; with overlap
``o = ceil(t * n)`` at least, two similar sets share a token among their first
``n - o + 1`` (the prefix), and ``m + 1`` tokens among their first
``n - o + 1 + m`` (the extended prefix).

- Rare tokens of the prefix are indexed singly.
- Where a prefix reaches the frequent tokens, the frequent tokens of the
  extended prefix fall into ``m`` classes by hash; of ``m + 1`` shared ones two
  are of one class, so all pairs within a class are indexed.  ``m`` grows with
  the set, which keeps the pairs linear in it.

Candidates are not all pairs of an index group.  First each member meets the
group's smallest and largest document; verified links are joined into components.
Only groups that still hold several components give pairs, of members of
different components.  Groups of the same members (as the tokens of one passage make
them; told by the count and 128 bits of hashes of the members) are compared once.  Two
documents that meet in many groups are a pair in few of them: each member knows its document's
``BEFORE`` groups before this one, in order of the keys, and where two members have one of these in common they have met
there; in the first of their common groups they have none.  A pair goes on only if the sets' sketches allow the
link: a sketch has ``SKETCH_BITS`` parities of token counts, and two sets differ
in at least as many tokens as their sketches differ in bits; large sets have a second
one that grows with them.  So the pairs that the
join makes follow the links across components, not the square of a group of
unlike sets that share a passage (it still compares the sketches of all of
them).  No link between components is lost, and a large group of
copies costs one candidate per member.  Links inside of a component that the
first step formed are neither sought nor verified: the result is the components, and
there is no count of links.

Frequent tokens are heavy hitters: those that recur within a task's texts and
in all make up at least ``1 / FREQUENT_SHARE`` of the documents.  There are
at most ``FREQUENT_SHARE`` times the mean set size of them, which is what is
broadcast; what is taken for frequent changes the work, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, written
from .components import components
from .shared_runs import LAST_ID, ordered_id, partners, small
from .vectors import batches, gram_hashes, is_space, mixed, octets, runs, span_hashes

WORDS = 5
THRESHOLD = 80  # per cent
FREQUENT_SHARE = 5000
FREQUENT_LEAST = 32
#: Tokens that a task counts at a time.
COUNTED = 2_000_000
#: Characters whose sets are formed at once; arrays of this size stay in the caches.
SET_CHARS = 500_000
#: Parities of a set's sketch, a multiple of 64.  Sets of up to some 1,000 tokens are told apart well.
SKETCH_BITS = 512
#: Sets from this size on have a second sketch of as many bits as tokens, to the power of two
#: below and up to the second number.  Beyond some 150,000 tokens it tells sets apart less and less.
FINE_FROM, FINE_BITS = 1024, 1 << 16
#: Extension of the prefix as a part of the set size.
EXTENSION = 0.05
#: Groups before it that a member knows.
BEFORE = 8


def token_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending; and where each text's begin."""
    codes, starts = octets(texts)
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint8(32), codes)
    ws, we = runs(~is_space(codes))
    h = span_hashes(codes, ws, we)
    edge = np.searchsorted(ws, starts)
    count = np.diff(edge)
    grams = gram_hashes(h, words)
    doc = np.repeat(np.arange(len(texts)), count)
    if len(grams):
        whole = doc[:len(grams)] == doc[words - 1:]
        owner, token = doc[:len(grams)][whole], grams[whole]
    else:
        owner, token = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):  # the whole sequence, told apart by its length
        short = np.array([gram_hashes(h[edge[i]:edge[i + 1]] + np.uint64(count[i]), count[i])[0] for i in few], np.uint64)
        owner, token = np.concatenate([owner, few]), np.concatenate([token, short])
    order = np.lexsort((token, owner))
    owner, token = owner[order], token[order]
    if len(owner):
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])))
        owner, token = owner[new], token[new]
    return token, np.searchsorted(owner, np.arange(len(texts) + 1))


def sketches(token: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A row of ``SKETCH_BITS // 64`` longs of each set: the parity of its tokens of each bit."""
    owner = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    place = owner * SKETCH_BITS + (mixed(token) % np.uint64(SKETCH_BITS)).astype(np.int64)
    at, many = np.unique(place, return_counts=True)
    odd = np.zeros((len(edge) - 1) * SKETCH_BITS, bool)
    odd[at[many % 2 == 1]] = True
    return np.packbits(odd).view(np.int64).reshape(len(edge) - 1, SKETCH_BITS // 64)


def fine_sketches(token: np.ndarray, edge: np.ndarray) -> list:
    """The second sketch of each set, None of small ones.  Its halves' exclusive or is the sketch of half the bits."""
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        bits = min(1 << (b - a).bit_length() - 1, FINE_BITS) if b - a >= FINE_FROM else 0
        odd = np.bincount((mixed(token[a:b]) % np.uint64(bits)).astype(np.int64), minlength=bits) % 2 == 1 if bits else None
        out.append(np.packbits(odd).view(np.int64) if bits else None)
    return out


def may_link(threshold: int) -> Column:
    """Whether sets x and y (``x_n``, ``x_sketch``, ...) can be similar.  Of ``d`` differing tokens, their intersection is
    ``(x_n + y_n - d) / 2`` and their union ``(x_n + y_n + d) / 2``.  Second sketches of one size, or of which one has
    twice the bits, are compared too; other sizes, and sets without, leave it open."""
    differ = sum((F.bit_count(F.col("x_sketch")[i].bitwiseXOR(F.col("y_sketch")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))

    def no_longer_than(fine: Column, other: Column) -> Column:
        half = (F.size(fine) / 2).cast("int")
        return F.when(F.size(fine) > F.size(other), F.zip_with(F.slice(fine, 1, half), F.slice(fine, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(fine)
    x, y = F.col("x_fine"), F.col("y_fine")
    finer = F.aggregate(F.zip_with(no_longer_than(x, y), no_longer_than(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)
    bound = lambda d: d * (100 + threshold) <= (F.col("x_n") + F.col("y_n")) * (100 - threshold)
    return bound(differ) & F.coalesce(bound(finer), F.lit(True))


def _profiles(words: int):
    """(doc_id, id, n, sig, sketch, fine) of each row, and (token, n) of tokens that recur in the task."""
    def run(frames) -> Iterator:
        import pyarrow as pa
        names = ["doc_id", "id", "n", "sig", "sketch", "fine", "token"]
        longs = pa.list_(pa.int64())
        held, size = [], 0

        def recurring():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            many = n > 1
            count = int(many.sum())
            return pa.RecordBatch.from_arrays([pa.nulls(count, pa.int64()), pa.nulls(count, pa.int64()), pa.array(n[many]), pa.nulls(count, pa.binary()), pa.nulls(count, longs), pa.nulls(count, longs),
                                               pa.array(token[many].view(np.int64))], names)
        for got in batches(frames, ["doc_id", "id", "text"], size=SET_CHARS):
            token, edge = token_sets(got["text"], words)
            n = np.diff(edge)
            sig = [blake2b(token[a:b].tobytes(), digest_size=16).digest() for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(got["doc_id"], pa.int64()), pa.array(got["id"], pa.int64()), pa.array(n), pa.array(sig),
                                              pa.array(list(sketches(token, edge)), longs), pa.array(fine_sketches(token, edge), longs), pa.nulls(len(n), pa.int64())], names)
            held.append(token)
            size += len(token)
            if size > COUNTED:
                yield recurring()
                held, size = [], 0
        if held:
            yield recurring()
    return run


def overlap_of(n: np.ndarray, threshold: int) -> np.ndarray:
    return -(-n * threshold // 100)


def steps(threshold: int) -> np.ndarray:
    """Set sizes at which a new size step begins; similar sets are in the same or adjoining steps."""
    return (100 / threshold) ** np.arange(0, 200) if threshold < 100 else np.arange(0, 2.0 ** 20)


def extension(n: float) -> int:
    return max(1, int(EXTENSION * n))


def index_keys(token: np.ndarray, frequent: np.ndarray, threshold: int, edges: np.ndarray) -> tuple[np.ndarray, int]:
    """Index keys of one set, and how many keys it shares at least with any
    similar set whose prefix is rare too."""
    n = len(token)
    o = int(overlap_of(np.int64(n), threshold))
    place = np.searchsorted(frequent, token)
    often = np.zeros(n, bool)
    inside = place < len(frequent)
    often[inside] = frequent[place[inside]] == token[inside]
    rare, heavy = token[~often], token[often]
    step = int(np.searchsorted(edges, n, "right")) - 1
    m = extension(edges[step - 1] if step else 1)  # what the smallest similar set extends by
    if n - o + 1 + m <= len(rare) and m + 1 <= o:
        # all of the extended prefix is rare: the tokens themselves
        return rare[:n - o + 1 + m], m + 1
    keys = [rare[:n - o + 1]]
    if n - o + 1 > len(rare):
        for version in (step, step + 1):  # with sets of this step and the one below, or the one above
            m = extension(edges[version - 1] if version else 1)
            if m + 1 > o:
                m = 1
            part = heavy[:max(n - o + 1 + m - len(rare), 0)]
            kind = part % np.uint64(m)
            order = np.lexsort((part, kind))
            part, kind = part[order], kind[order]
            salt = np.uint64(0x5851F42D4C957F2D * (version + 1) % (1 << 64))
            bounds = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1], [True]))) if len(part) else [0]
            for a, b in zip(bounds[:-1], bounds[1:]):
                i, j = np.triu_indices(b - a, 1)
                keys.append(mixed(part[a:b][i] * np.uint64(3) + mixed(part[a:b][j] ^ salt)))
    return np.concatenate(keys), 1


def _index(words: int, threshold: int, shared):
    """(key, doc_id, n, least) of each representative."""
    edges = steps(threshold)

    def run(frames) -> Iterator:
        import pyarrow as pa
        frequent = shared.value
        for got in batches(frames, ["doc_id", "text"], size=SET_CHARS):
            token, edge = token_sets(got["text"], words)
            keys, least = [], []
            for a, b in zip(edge[:-1], edge[1:]):
                # a set of fewer than 4 is similar to equal sets only
                k, s = index_keys(token[a:b], frequent, threshold, edges) if b - a > 3 or threshold < 75 else (token[:0], 1)
                keys.append(k)
                least.append(s)
            many = np.array([len(k) for k in keys])
            rep = lambda v: pa.array(np.repeat(np.asarray(v, np.int64), many))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), rep(got["doc_id"]),
                                              rep(np.diff(edge)), rep(least)], ["key", "doc_id", "n", "least"])
    return run


def verified(pairs: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")

    def sets(frames):
        import pyarrow as pa
        for got in batches(frames, ["doc_id", "text"], size=SET_CHARS):
            token, edge = token_sets(got["text"], words)
            yield pa.RecordBatch.from_arrays([pa.array(got["doc_id"], pa.int64()),
                                              pa.array([token[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])])], ["doc_id", "tokens"])

    def compare(frames):
        import pyarrow as pa
        for frame in frames:
            keep = []
            for x, y in zip(frame["x"], frame["y"]):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.searchsorted(p, q)
                both = int((p[np.minimum(at, len(p) - 1)] == q).sum()) if len(p) else 0
                keep.append(100 * both >= threshold * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([frame["a"], frame["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    tokens = written(docs.join(small(ids), "doc_id", "left_semi").mapInArrow(sets, "doc_id long, tokens binary"), "tokens")
    side = lambda c, v: tokens.select(F.col("doc_id").alias(c), F.col("tokens").alias(v))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(compare, "a long, b long")


def node_of(doc_id: str, row: str) -> Column:
    """What stands for a row among the links: its id, or a hash if its id is of several rows."""
    return F.when(F.col(row) == 0, F.col(doc_id)).otherwise(F.xxhash64(doc_id, row))


def similar_groups(docs: DataFrame, *, words: int = WORDS, threshold: int = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text", rows: bool = False) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, ``n_shingles`` and ``component_id``
    (smallest id reachable by links, its own included).

    Words lie between ASCII white space, A-Z in lower case; a text of fewer than ``words`` words is
    one shingle.  Two rows link when ``100 * intersection >= threshold *
    union`` of their sets.  Null, empty and blank texts have no shingle and
    link with nothing; a null id is larger than any other and stays null.
    Repeated rows link with each other; rows of different texts do not by sharing an id, or having none.  Empty
    table: no rows.  Other columns are not read.  Sets are of 64-bit hashes.  With ``rows``, each row also has ``node``
    (``node_of`` its id and its ``row`` of ``keyed``) and ``first``, whether it is the smallest of its
    component (of smallest id, and among the rows of that id one).
    """
    read = (keyed(docs.select(ordered_id(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
            .select(node_of("doc_id", "row").alias("doc_id"), F.col("doc_id").alias("id"), "text"))
    spark = docs.sparkSession
    profile = written(read.mapInArrow(_profiles(words), "doc_id long, id long, n long, sig binary, sketch array<long>, fine array<long>, token long"), "profiles")
    every = profile.where("token IS NULL").select("doc_id", "id", "n", "sig", "sketch", "fine")
    least_of = F.min(F.struct("id", "doc_id"))
    classes = written(every.where("n > 0").groupBy("sig", "n").agg(least_of.alias("least"), F.first("sketch").alias("sketch"), F.first("fine").alias("fine"))
                      .select("sig", "n", "least", F.col("least.doc_id").alias("doc_id"), "sketch", "fine"), "classes")
    least = max(FREQUENT_LEAST, every.count() // FREQUENT_SHARE)
    # heavy hitters: bounded by FREQUENT_SHARE times the mean set size
    heavy = profile.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("token").toPandas()
    shared = spark.sparkContext.broadcast(np.sort(heavy["token"].to_numpy(np.int64).view(np.uint64)))
    chosen = read.join(small(classes.select("doc_id")), "doc_id", "left_semi")
    index = chosen.mapInArrow(_index(words, threshold, shared), "key long, doc_id long, n long, least long")
    place = F.struct("doc_id", "n", "least")
    groups = written(index.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                     .where("low.doc_id <> high.doc_id"), "groups")
    members = written(partners(index, groups, "key").join(groups, "key"), "members")

    def near(n, m):
        return F.least(n, m) * 100 >= F.greatest(n, m) * threshold
    ends = [members.select(F.col(f"{e}.doc_id").alias("a"), F.col("doc_id").alias("b"), F.least("least", f"{e}.least").alias("least"))
            .where(F.col("doc_id") != F.col(f"{e}.doc_id")).where(near(F.col("n"), F.col(f"{e}.n"))) for e in ("low", "high")]
    stars = (ends[0].unionByName(ends[1]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "least")
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("least").alias("least"))
             .where("shared >= least").select("a", "b"))
    links = written(verified(written(stars, "stars"), read, words, threshold).distinct(), "links")
    label = written(components(links), "labels")
    own = (members.select("key", "doc_id", "n", "least").distinct().join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
           .withColumn("component", F.coalesce("component", "doc_id")))
    # keys of the same members are one group
    open_keys = (own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("many"),
                                        F.bit_xor(F.xxhash64("doc_id")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("two"))
                 .where("low <> high").groupBy("many", "one", "two").agg(F.min("key").alias("key")).select("key"))
    before = F.collect_list("key").over(Window.partitionBy("doc_id").orderBy("key").rowsBetween(-BEFORE, -1))
    rest = written(own.join(open_keys, "key").select("key", "doc_id", "n", "component", before.alias("before"))
                   .join(classes.select("doc_id", "sketch", "fine"), "doc_id"), "open")
    x, y = (rest.select("key", *[F.col(c).alias(f"{e}_{c}") for c in ("doc_id", "n", "component", "before", "sketch", "fine")]) for e in "xy")
    across = (x.join(y, "key").where("x_doc_id < y_doc_id AND x_component <> y_component").where(near(F.col("x_n"), F.col("y_n")))
              .where(may_link(threshold)).where(~F.arrays_overlap("x_before", "y_before"))
              .select(F.col("x_doc_id").alias("a"), F.col("y_doc_id").alias("b")).distinct())
    more = written(verified(written(across, "across"), read, words, threshold).distinct(), "more")
    final = components(links.unionByName(more))
    # of each linked class the component, named by the smallest of all of its rows
    linked = written(classes.join(final.withColumnRenamed("node", "doc_id"), "doc_id").select("sig", "n", "least", "component"), "linked")
    named = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    of_class = linked.join(named, "component").select("sig", "n", "smallest")
    rep = classes.select("sig", "n", "least").join(of_class, ["sig", "n"], "left").select("sig", "n", F.coalesce("smallest", "least").alias("smallest"))
    out = every.join(rep, ["sig", "n"], "left").withColumn("smallest", F.coalesce("smallest", F.struct("id", "doc_id")))
    back = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    more_of = [F.col("doc_id").alias("node"), (F.col("doc_id") == F.col("smallest.doc_id")).alias("first")] if rows else []
    return out.select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("smallest.id").alias("component_id"), *more_of)
