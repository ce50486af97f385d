"""Alignment of two tokenizers over the same bytes, and the corpus-wide counts of linked ids.

Tokenizer A (byte-level BPE) codes a blank and the text, B (sentencepiece) the text, before which it
puts a blank itself; both then cover the same bytes.  Tokens whose byte ranges overlap are
linked, and the connected tokens are a group, which ends where tokens of both end.

Groups are labelled by pointer jumping: every token points to the token farthest right that it overlaps, a token
of B that nothing overlaps farther right to itself; taking the successor's successor, over all
tokens of a batch at once, doubles the distance until all point to their group's last
token.  As texts are cut into parts that both tokenizers code independently (``token_parts``), a task
does this once for each different part, and a text's figures are sums over its parts.

The corpus is read twice: for the counts of id pairs, summed a task at a time before they are shuffled, and for the rows.
The counts go to the tasks as sorted arrays up to ``BROADCAST_PAIRS`` pairs; beyond, the
rows' distinct pairs are joined to them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .packing import LONG_WORD
from .token_parts import parts_of, word_ids

#: Pairs (two longs and a flag) that are sent to every task.
BROADCAST_PAIRS = 3_000_000
#: Parts that a task remembers at most, beyond those of one slice of texts.
MOST_PARTS = 200_000
#: Characters of texts, whose parts are aligned at once.
SLICE_CHARS = 4_000_000
PAIR_BITS = 32
#: Parts with other white space than the usual, or with an edge at which no text is cut.
ALONE = re.compile(r"[^\S \n\t\r]|^(?![!-~\w])|(?<![!-~\w])\Z")


def byte_spellings(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file; no bytes for ids that have no entry."""
    import json
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # byte-level BPE writes a byte as its own character if printable, else as one from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocabulary = spec["model"]["vocab"]
    out = [b""] * (max([*vocabulary.values(), *(t["id"] for t in spec.get("added_tokens") or [])]) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else b""
    return out


def piece_spellings(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def blanks_lead(model) -> bool:
    """Whether blanks only lead the pieces of a model that changes no character, so that a text may be cut before one."""
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    normal = proto.normalizer_spec
    # in the trainer's numbering, 2 is BPE
    return (proto.trainer_spec.model_type == 2 and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
            and not normal.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix
            and all("▁" not in p.piece.lstrip("▁") for p in proto.pieces))


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token of B in the group of each token of A and of B, given where they end; both sides start at
    byte 0, have no empty token and end together."""
    n = len(ends_a)
    starts_a, starts_b = (np.concatenate(([0], e[:-1])) for e in (ends_a, ends_b))
    # a token's last byte lies in the farthest token that it overlaps
    right_of_a = np.searchsorted(starts_b, ends_a, "left") - 1
    right_of_b = np.searchsorted(starts_a, ends_b, "left") - 1
    own = n + np.arange(len(ends_b))
    to = np.concatenate((n + right_of_a, np.where(ends_a[right_of_b] > ends_b, right_of_b, own))) if n else own
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            return to[:n] - n, to[n:] - n
        to = farther


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places (in A, in B) of overlapping tokens."""
    starts_a, starts_b = (np.concatenate(([0], e[:-1])) for e in (ends_a, ends_b))
    first = np.searchsorted(ends_b, starts_a, "right")
    many = np.searchsorted(starts_b, ends_a, "left") - first
    of_a = np.repeat(np.arange(len(ends_a)), many)
    return of_a, np.arange(len(of_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)


class Places(dict):
    """Numbers of parts, in the order in which they are first asked for; ``fresh`` are those not yet aligned."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, part: str) -> int:
        self.fresh.append(part)
        at = self[part] = len(self)
        return at


class Aligner:
    """Aligned parts of texts; ``add`` numbers them, ``align`` works those that are new."""

    def __init__(self, a_path: str, b_path: str, known=None, spell: bool = True):
        import sentencepiece
        self.words = word_ids(a_path)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.whole = self.words.by_rank is None or not blanks_lead(self.model)
        self.bytes_a, self.bytes_b = byte_spellings(a_path), piece_spellings(self.model)
        self.length_a, self.length_b = (np.array([len(x) for x in s]) for s in (self.bytes_a, self.bytes_b))
        self.known, self.spell = known, spell
        if spell:
            text = lambda n, end: np.array([f"{i}{end}" for i in range(n)], dtype=object)
            self.inner_a, self.last_a = (text(len(self.bytes_a), e) for e in ",|")
            self.inner_b, self.last_b = (text(len(self.bytes_b), e) for e in ",;")
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.figures = np.zeros((0, 6), np.int64)  # n_a, n_b, n_groups, n_links, n_best, count_sum
        self.good = np.zeros(0, bool)
        self.groups: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.pair_ends = np.zeros(0, np.int64)

    def add(self, text: str) -> list[int]:
        return list(map(self.place.__getitem__, [text] if self.whole else parts_of(text)))

    def _coded(self, parts: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of both sides, how many each part has, and whether a part's bytes are the same on both."""
        whole = (" " + " ".join(parts)).encode()
        # where each part's blank is: a character starts at every byte that continues none
        starts = np.flatnonzero((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)
        chars = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        edges = np.append(starts[np.cumsum(chars) - chars], len(whole))
        ids_a, many_a = self._coded_a(parts)
        b = self.model.encode(parts, num_threads=1)
        many_b = np.fromiter(map(len, b), np.int64, len(b))
        ids_b = np.fromiter(chain.from_iterable(b), np.int64, int(many_b.sum()))
        joined = lambda spelt, ids: b"".join(map(spelt.__getitem__, ids.tolist()))
        side = lambda length, ids, many: np.diff(np.append(0, np.cumsum(length[ids]))[np.append(0, np.cumsum(many))])
        sizes = np.diff(edges)
        good = (side(self.length_a, ids_a, many_a) == sizes) & (side(self.length_b, ids_b, many_b) == sizes)
        if not good.all() or joined(self.bytes_a, ids_a) != whole or joined(self.bytes_b, ids_b) != whole:
            at_a, at_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
            good = np.array([joined(self.bytes_a, ids_a[s:s + m]) == whole[x:y] and joined(self.bytes_b, ids_b[t:t + k]) == whole[x:y]
                             for s, m, t, k, x, y in zip(at_a, many_a, at_b, many_b, edges, edges[1:])])
            ids_a, ids_b = ids_a[np.repeat(good, many_a)], ids_b[np.repeat(good, many_b)]
            many_a, many_b = many_a * good, many_b * good
        return ids_a, ids_b, many_a, many_b, good

    def _coded_a(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A after a blank.  Short parts between whose neighbours a text may be cut are coded as one text, whose
        tokens then fall to the parts by their ends; the others alone."""
        by_rank, alone = self.words.by_rank, ALONE.search
        together = [i for i, p in enumerate(parts) if len(p) <= LONG_WORD and not alone(p)] if by_rank else []
        if together and self.words.probes:
            for i in together[:self.words.probes]:
                self.words[parts[i]]
        found: list = [None] * len(parts)
        if together:
            chosen = [parts[i] for i in together]
            text = " " + " ".join(chosen)
            ids = np.array(by_rank(text), np.int64)
            ends = np.cumsum(self.length_a[ids])
            bytes_of = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in chosen), np.int64, len(chosen)))
            last = np.searchsorted(ends, bytes_of, "left")
            if not np.array_equal(ends[last], bytes_of):
                raise RuntimeError("a token reaches over a blank")
            if len(together) == len(parts):
                self.words.clear()
                return ids, np.diff(np.append(-1, last))
            for i, x in zip(together, np.split(ids, last[:-1] + 1)):
                found[i] = x
        for i, p in enumerate(parts):
            if found[i] is None:
                found[i] = np.frombuffer(self.words[p], "<u4").astype(np.int64)
        self.words.clear()
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def align(self) -> None:
        if not self.place.fresh:
            return
        ids_a, ids_b, many_a, many_b, good = self._coded(self.place.fresh)
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        parts = len(good)
        part_a, part_b = np.repeat(np.arange(parts), many_a), np.repeat(np.arange(parts), many_b)
        last_of_a, last_of_b = labels(ends_a, ends_b)
        of_a, of_b = links(ends_a, ends_b)
        final = last_of_b == np.arange(len(ids_b))
        pair = (ids_a[of_a] << PAIR_BITS) | ids_b[of_b]
        part_of = part_a[of_a]
        count = lambda x: np.bincount(x, minlength=parts)
        figures = np.stack([many_a, many_b, count(part_b[final]), count(part_of), *np.zeros((2, parts), np.int64)], axis=1).astype(np.int64)
        if self.known is not None:
            pairs, counts, best = self.known
            at = np.searchsorted(pairs, pair)
            total = lambda x: np.diff(np.append(0, np.cumsum(x))[np.append(0, np.cumsum(figures[:, 3]))])
            figures[:, 4], figures[:, 5] = total(best[at].astype(np.int64)), total(counts[at])
        else:
            self.pairs.append(pair)
            self.pair_ends = np.append(self.pair_ends, (self.pair_ends[-1] if len(self.pair_ends) else 0) + np.cumsum(figures[:, 3]))
        if self.spell:
            self.groups += self._spelt(ids_a, ids_b, many_a, many_b, last_of_a, last_of_b, final)
        self.figures, self.good = np.concatenate((self.figures, figures)), np.append(self.good, good)
        self.place.fresh.clear()

    def _spelt(self, ids_a, ids_b, many_a, many_b, last_of_a, last_of_b, final) -> list[str]:
        """Each part's groups as ``a1,a2|b1;``, both sides in order."""
        group = np.cumsum(final) - 1
        group_a, group_b = group[last_of_a], group[last_of_b]
        in_a, in_b = (np.cumsum(np.bincount(g, minlength=int(final.sum()))) for g in (group_a, group_b))
        out = np.empty(len(ids_a) + len(ids_b), dtype=object)
        ends = np.append(group_a[1:] != group_a[:-1], True) if len(ids_a) else np.zeros(0, bool)
        out[np.arange(len(ids_a)) + np.append(0, in_b)[group_a]] = np.where(ends, self.last_a[ids_a], self.inner_a[ids_a])
        out[np.arange(len(ids_b)) + in_a[group_b]] = np.where(final, self.last_b[ids_b], self.inner_b[ids_b])
        tokens, cuts = out.tolist(), np.append(0, np.cumsum(many_a + many_b)).tolist()
        return ["".join(tokens[s:e]) for s, e in zip(cuts, cuts[1:])]

    def pair_counts(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and their links, when part i occurs ``times[i]`` times."""
        pairs = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        weight = np.repeat(times[:len(self.figures)], self.figures[:, 3])
        found, at = np.unique(pairs, return_inverse=True)
        counts = np.zeros(len(found), np.int64)
        np.add.at(counts, at, weight)
        return found[counts > 0], counts[counts > 0]


def _slices(batches: Iterator) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (never null) in slices of some ``SLICE_CHARS`` characters."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, t in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
            ids.append(i)
            texts.append(t or "")
            held += len(texts[-1])
            if held >= SLICE_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _numbered(aligner: Aligner, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of all texts, how many each has, and which texts have tokens."""
    found = [aligner.add(t) if t else [] for t in texts]
    aligner.align()
    many = np.array([len(x) for x in found])
    places = np.array([p for x in found for p in x], np.int64)
    bad = np.zeros(len(texts), bool)
    bad[np.repeat(np.arange(len(texts)), many)[~aligner.good[places]]] = True
    return places, many, (many > 0) & ~bad


def pair_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Links of each pair of ids (``pair``: A's id shifted by 32 bits, and B's) in all texts, ``n``, and whether no pair of
    B's id has more, ``best``."""
    def run(batches):
        import pyarrow as pa
        aligner = Aligner(a_path, b_path, spell=False)
        times = np.zeros(0, np.int64)
        made = lambda: pa.RecordBatch.from_arrays([pa.array(x) for x in aligner.pair_counts(times)], ["pair", "n"])
        for _, texts in _slices(batches):
            places, many, tokens = _numbered(aligner, texts)
            seen = np.bincount(places[np.repeat(tokens, many)], minlength=len(aligner.figures))
            seen[:len(times)] += times
            times = seen
            if len(times) > MOST_PARTS:
                yield made()
                aligner.clear()
                times = np.zeros(0, np.int64)
        yield made()

    counts = written(docs.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    # at most a row for each id of B's vocabulary
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


ROWS = ("id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, "
        "row long, pairs array<long>, times array<int>")


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text",
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose pair of ids no pair
    with the same id of B exceeds in links over all rows; ties are all best), ``count_sum`` (sum over the links of their pair's
    links in all rows) and ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of A and B in order).

    A text that is null, empty, or not spelt again by either tokenizer's tokens has none: zeros and an empty ``groups``, and
    no part in the counts.  Every row counts and has its row, also of equal ids or texts, or without an id.  Texts are coded whole, at any
    length, as long as ``groups`` stays below the 2 GB of a value.  Other columns are not read.  An empty table has no rows.

    A model that changes characters or joins across blanks is given each text as one part."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = written(pair_table(docs, a_path, b_path), "pair-counts")
    joined = counts.count() > broadcast_pairs
    sent = None
    if not joined:
        got = counts.orderBy("pair").toArrow()
        sent = docs.sparkSession.sparkContext.broadcast(tuple(got[c].to_numpy() for c in ("pair", "n", "best")))
    ddl = ROWS.format(id_type=docs.schema["id"].dataType.simpleString())

    def run(batches):
        import pyarrow as pa
        aligner = Aligner(a_path, b_path, known=None if joined else sent.value)
        row = TaskContext.get().partitionId() << 40
        for ids, texts in _slices(batches):
            places, many, tokens = _numbered(aligner, texts)
            starts = np.cumsum(many) - many
            figures = np.zeros((len(texts), 6), np.int64)
            if len(places):
                kept = np.flatnonzero(tokens)
                figures[many > 0] = np.add.reduceat(aligner.figures[places], starts[many > 0], axis=0)
                figures[~tokens] = 0
                spelt = [""] * len(texts)
                for i in kept.tolist():
                    spelt[i] = "".join(map(aligner.groups.__getitem__, places[starts[i]:starts[i] + many[i]].tolist()))[:-1]
            else:
                spelt = [""] * len(texts)
            pairs, times = [None] * len(texts), [None] * len(texts)
            if joined:
                flat, ends = np.concatenate(aligner.pairs) if aligner.pairs else None, np.append(0, aligner.pair_ends)
                for i in np.flatnonzero(tokens).tolist():
                    own = np.concatenate([flat[ends[p]:ends[p + 1]] for p in places[starts[i]:starts[i] + many[i]]])
                    pairs[i], times[i] = np.unique(own, return_counts=True)
            # a list of its own for some MB of groups at a time
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and held < 1 << 26:
                    held += len(spelt[end])
                    end += 1
                s = slice(at, end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[s], type=id_kind), *[pa.array(figures[s, k]) for k in range(6)], pa.array(spelt[s], pa.string()),
                     pa.array(row + np.arange(at, end)), pa.array(pairs[s], pa.list_(pa.int64())), pa.array(times[s], pa.list_(pa.int32()))], names)
                at = end
            row += len(texts)
            if len(aligner.figures) > MOST_PARTS:
                aligner.clear()

    from pyspark.sql.pandas.types import to_arrow_type
    id_kind, names = to_arrow_type(docs.schema["id"].dataType), [c.split(" ")[0] for c in ddl.split(", ")]
    out = docs.mapInArrow(run, ddl)
    if joined:
        out = written(out, "aligned")
        each = out.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
        each = each.withColumnRenamed("pairs", "pair").join(counts, "pair")
        sums = each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
                                       F.sum(F.col("n") * F.col("times")).alias("count_sum"))
        out = out.drop("n_best", "count_sum").join(sums, "row", "left").fillna({"n_best": 0, "count_sum": 0})
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
