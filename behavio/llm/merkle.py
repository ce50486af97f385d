"""Merkle manifest of a dataset with nested-interval labels.

Each row is a leaf.  The leaves of one tree (a language, say) ascend by id; level
by level every two consecutive nodes become the digest of their digests, a last node
without partner the digest of its own, until one is left: the subroot.  The
subroots of all trees, in the order of their names, make the root in the same way.

A node is labelled by the interval of leaf ranks that it covers.  Levels are worked in bands of
``BAND``: the nodes of a band fall into buckets, one for each interval of the band's top
level, so a bucket has at most ``2**BAND`` entries, and one row (a *block*) holds
them with all their ancestors inside of the band.  The node of the next band whose interval contains a
block's is found by a join on (tree, bucket), which attaches all ancestors above to the
block at once; leaves never move with their proofs.  Inside of a parent's
interval, what a node's own interval leaves over is its sibling's.

Ranks of a tree come from one range shuffle of all leaves and the counts of (tree, range), so
no tree meets in one task.  Equal rows are counted first and dealt out again in
runs of ``COPIES``.  Texts are read once, for their digests, and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .shared_runs import small

#: Levels of a band; a block has at most 2**BAND entries of some 200 bytes.
BAND = 10
#: Equal rows that are ranked as one.
COPIES = 4096
#: Rows of a table with a tree's name and a proof, up to which it is broadcast.
BROADCAST_BLOCKS = 100_000


def sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: of each field ``-`` if null, else the byte count of its text, ``:`` and the text."""
    texts = [f.cast("string") for f in fields]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def tree_key(name: Column) -> Column:
    """Never null; null names come first, the others in the order of their bytes."""
    return F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name.cast("string")))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, order columns, others, all comparable) with ``rank`` (from 0 in their tree) and ``n`` (rows of the tree)."""
    rest = [c for c in rows.columns if c not in ("tree", *order)]
    keys = ["tree", *order, *rest]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES).cast("long"))))
    dealt = runs.repartitionByRange(*keys, "_run").sortWithinPartitions(*keys, "_run")
    each = F.sequence(F.lit(1).cast("long"), F.least(F.col("_copies") - F.col("_run"), F.lit(COPIES)))
    # the id is the range's number, then the place in it
    placed = (dealt.withColumn("_copy", F.explode(each)).withColumn("_at", F.monotonically_increasing_id())
              .select(*keys, F.shiftright("_at", 33).alias("_range"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place")))
    placed = written(placed, "leaf-ranges")
    counts = placed.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    of_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_rows").over(of_tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(counts.select("tree", "_range", (before - F.col("_first")).alias("_start"), F.sum("_rows").over(of_tree).alias("n")), "starts")
    return (placed.join(small(starts, BROADCAST_BLOCKS), ["tree", "_range"])
            .select(*keys, (F.col("_start") + F.col("_place")).alias("rank"), "n"))


def _parents(nodes: Column) -> Column:
    pair = lambda i: F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), lambda i: sha(pair(i)))


def _shift(direction: str, value: Column, by: Column | int) -> Column:
    return F.call_function(f"shift{direction}", value, by if isinstance(by, Column) else F.lit(by))


def _cut(value: Column, bits: Column | int) -> Column:
    """``value`` with its lowest ``bits`` bits cleared: where the interval of that width around it starts."""
    return _shift("left", _shift("right", value, bits), bits)


def blocks(nodes: DataFrame, band: int, base: int) -> DataFrame:
    """One row for each bucket of the band that starts at level ``base``, over that level's nodes (tree, lo, leaves,
    digest, item): tree, leaves (of the tree), lo and hi (the interval of leaf ranks), ``height`` (levels of
    the tree above the entries, in this band), ``items``, ``levels`` (digests of each level, the entries first) and ``top``."""
    wide = base + band
    levels = F.when(F.col("leaves") > 1, F.length(F.bin(F.col("leaves") - 1))).otherwise(0)
    out = (nodes.groupBy("tree", _cut(F.col("lo"), wide).alias("block"))
           .agg(F.max("leaves").alias("leaves"), F.array_sort(F.collect_list(F.struct("lo", "digest", "item"))).alias("entries"))
           .withColumnRenamed("block", "lo").withColumn("hi", F.least(F.col("lo") + (1 << wide), F.col("leaves")))
           .withColumn("height", F.greatest(F.least(levels - base, F.lit(band)), F.lit(0)).cast("int"))
           .withColumn("l0", F.col("entries.digest")))
    for k in range(1, band + 1):
        out = out.withColumn(f"l{k}", F.when(F.col("height") >= k, _parents(F.col(f"l{k - 1}"))))
    out = out.withColumn("levels", F.array(*[f"l{k}" for k in range(band + 1)]))
    return out.select("tree", "leaves", "lo", "hi", "height", F.col("entries.item").alias("items"), "levels",
                      F.get(F.get("levels", F.col("height")), F.lit(0)).alias("top"))


def _siblings(entry: Column, base: int) -> Column:
    """Path inside of a block from the entry that starts at leaf rank ``entry``: for each level the side and digest of what the
    parent's interval holds besides the node's own, or an empty text where that is nothing."""
    one = F.lit(1).cast("long")

    def step(k: Column) -> Column:
        level = k + base
        own_lo, lo = _cut(entry, level), _cut(entry, level + 1)
        own_hi = F.least(own_lo + _shift("left", one, level), F.col("hi"))
        hi = F.least(lo + _shift("left", one, level + 1), F.col("hi"))
        node = lambda start: F.get(F.get("levels", k), _shift("right", start - F.col("lo"), level).cast("int"))
        return (F.when(own_lo > lo, F.concat(F.lit("L"), node(lo))).when(own_hi < hi, F.concat(F.lit("R"), node(own_hi)))
                .otherwise(F.lit("")))
    return F.when(F.col("height") > 0, F.transform(F.sequence(F.lit(0), F.col("height") - 1), step)).otherwise(F.array().cast("array<string>"))


def _entries(size_of: Column, body) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(0), size_of - 1), body))


def attached(below: DataFrame, above: DataFrame, band: int, base: int) -> DataFrame:
    """Entries (tree, lo, hi, item, digest, rest, ends) of the blocks ``below`` with their whole paths: ``above`` are the
    nodes at the blocks' tops (tree, lo, hi, rest, ends), ``rest`` being the path from there to the root."""
    names = above.select(F.col("tree").alias("above_tree"), F.col("lo").alias("above_lo"), F.col("hi").alias("above_hi"), "rest", "ends")
    bucket = lambda c: _shift("right", F.col(c), base + band)
    inside = ((F.col("tree") == F.col("above_tree")) & (bucket("lo") == bucket("above_lo"))
              & (F.col("above_lo") <= F.col("lo")) & (F.col("hi") <= F.col("above_hi")))
    joined = below.join(small(names, BROADCAST_BLOCKS), inside)
    start = lambda i: F.col("lo") + _shift("left", i.cast("long"), base)
    each = _entries(F.size("items"), lambda i: F.struct(
        start(i).alias("lo"), F.least(start(i) + (1 << base), F.col("hi")).alias("hi"), F.get("items", i).alias("item"),
        F.get(F.get("levels", F.lit(0)), i).alias("digest"), F.concat(_siblings(start(i), base), F.col("rest")).alias("rest")))
    return joined.select("tree", "ends", each.alias("e")).select("tree", "ends", "e.*")


def grown(nodes: DataFrame, band: int, name: str) -> list[DataFrame]:
    """The blocks of each band, from the leaves (tree, lo, leaves, digest, item) to the band in which every tree has one block."""
    out, base = [], 0
    while True:
        out.append(written(blocks(nodes, band, base), f"{name}-{len(out)}"))
        most = out[-1].agg(F.max("leaves")).first()[0] or 0
        base += band
        if most <= 1 << base:
            return out
        nodes = out[-1].select("tree", "lo", "leaves", F.col("top").alias("digest"), F.lit(None).cast("string").alias("item"))


def labelled_nodes(bands: list[DataFrame], band: int) -> DataFrame:
    """All nodes of the trees: tree, level (0: leaves), lo and hi (covered leaf ranks, hi not included) and digest."""
    found = None
    for b, of in enumerate(bands):
        base = b * band
        # a band's lowest level is the highest of the one below
        first = 0 if b == 0 else 1
        level = (of.where(F.col("height") >= first).select("*", F.explode(F.sequence(F.lit(first), F.col("height"))).alias("k"))
                 .select("tree", "lo", "hi", (F.col("k") + base).alias("level"), F.posexplode(F.get("levels", F.col("k"))).alias("i", "digest")))
        start = F.col("lo") + _shift("left", F.col("i").cast("long"), F.col("level"))
        end = F.least(start + _shift("left", F.lit(1).cast("long"), F.col("level")), F.col("hi"))
        part = level.select("tree", "level", start.alias("lo"), end.alias("hi"), "digest")
        found = part if found is None else found.unionByName(part)
    return found


def paths(bands: list[DataFrame], ends: DataFrame, band: int) -> DataFrame:
    """Leaves (tree, lo, hi, item, digest, rest, ends) with their paths; the given ``ends`` hold what lies above each tree's
    top (tree, rest, ends)."""
    above = ends.select("tree", F.lit(0).cast("long").alias("lo"), F.lit((1 << 63) - 1).alias("hi"), "rest", "ends")
    for k in range(len(bands) - 1, 0, -1):
        above = written(attached(bands[k], above, band, k * band).select("tree", "lo", "hi", "rest", "ends"), "paths")
    return attached(bands[0], above, band, 0)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    def up(h: Column, s: Column) -> Column:
        side, other = F.substring(s, 1, 1), F.substring(s, 2, 64)
        return sha(F.when(side == "L", F.concat(other, h)).otherwise(F.concat(h, other)))
    return F.aggregate(path, leaf, up)


def manifest(leaves: DataFrame, *, tree: str = "tree", order: str = "id", leaf: str = "leaf", claimed: str | None = None,
             band: int = BAND) -> DataFrame:
    """Proofs of all rows of ``leaves``: ``tree``, ``order``, ``leaf``, ``claimed`` (a digest to be checked in place of
    the leaf, which it is where null or not given), ``rank`` (of the leaf in its tree), ``subroot``,
    ``root``, ``proof`` (from the leaf's level to the root's, ``L`` or ``R`` and the digest of the sibling on that side, or an empty text
    where there is none), ``folded_root`` (from the claimed digest and the proof) and ``verified``.

    Rows of one tree are ordered by ``order`` (null first), then by the leaf and the claimed digest; each of several equal
    rows is a leaf of its own.  A null tree is a tree, the first one.  An empty table has no rows.  Other
    columns are not read.  Texts of any length enter as digests only."""
    rows = leaves.select(tree_key(F.col(tree)).alias("tree"), F.col(order).alias("id"), F.col(leaf).alias("leaf"),
                         F.coalesce(F.col(claimed) if claimed else F.col(leaf), F.col(leaf)).alias("claimed"))
    nodes = ranked(rows, ["id", "leaf", "claimed"]).select(
        "tree", F.col("rank").alias("lo"), F.col("n").alias("leaves"), F.col("leaf").alias("digest"), F.struct("id", "claimed").alias("item"))
    bands = grown(nodes, band, "blocks")
    subroots = bands[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
    names = ranked(subroots, ["name", "digest"]).select(
        "tree", F.col("rank").alias("lo"), F.col("n").alias("leaves"), "digest", F.col("name").alias("item"))
    upper = grown(names, band, "subroots")
    root = upper[-1].select("tree", F.col("top").alias("ends"), F.array().cast("array<string>").alias("rest"))
    ends = F.struct(F.col("digest").alias("subroot"), F.col("ends").alias("root")).alias("ends")
    found = paths(bands, written(paths(upper, root, band).select(F.col("item").alias("tree"), "rest", ends), "roots"), band)
    out = found.select(F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias(tree), F.col("item.id").alias(order),
                       F.col("digest").alias(leaf), "item.claimed", F.col("lo").alias("rank"), "ends.subroot", "ends.root",
                       F.col("rest").alias("proof"))
    out = out.withColumn("folded_root", folded(F.col("claimed"), F.col("proof")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings, in order."""
    return sha(F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), ""))
