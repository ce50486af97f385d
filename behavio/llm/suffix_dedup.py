"""Removal of byte strings that occur earlier, by sorted suffixes.

Passages that recur are gathered into shards (see ``shared_runs``).  In
a shard the suffixes at all window starts are sorted as strings of
``width`` bytes by deep-shallow sorting: a multikey quicksort by eight bytes
at a time down to ``SHALLOW`` bytes, then the suffixes that still share
that prefix go into a blind trie, which tests only the branching bytes on the
way down and compares in full once, at the leaf.  Suffixes that end in one leaf
are equal windows; all but the earliest are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared_runs as S
from .common import keyed
from .vectors import batches, octets

WIDTH = 100
#: Bytes of an anchor.
K = 24
SHALLOW = 32
SHARD_BYTES = 1 << 20


def characters_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one ordered value."""
    out = np.zeros(len(at), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | data[at + j]
    return out


def shallow_groups(data: np.ndarray, at: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Groups of two or more suffixes with equal first ``depth`` bytes, in
    order.  Multikey quicksort with eight bytes as a character: all groups
    of a level are split by their next character at once."""
    order = np.arange(len(at))
    group = np.zeros(len(at), np.int64)
    for d in range(0, depth, 8):
        key = characters_at(data, at[order] + d)
        by = np.lexsort((key, group))
        order, group, key = order[by], group[by], key[by]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1  # a suffix alone in its group is in place
        order, group = order[many], group[many]
        if not len(order):
            return
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    for a, b in zip(edges[:-1], edges[1:]):
        yield order[a:b]


class BlindTrie:
    """Orders strings of one length that share a prefix; equal ones meet in a leaf."""
    __slots__ = ("root", "width")

    def __init__(self, width: int):
        self.root = None
        self.width = width

    def leaf(self, text: bytes) -> list:
        """The leaf [text, members] of ``text``, which is made if it is new."""
        node = self.root
        if node is None:
            self.root = made = [text, []]
            return made
        while len(node) == 3:  # a branch [place, byte -> node, None]; unknown bytes go any way
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        if node[0] == text:
            return node
        other = node[0]
        differs = int.from_bytes(text, "big") ^ int.from_bytes(other, "big")
        place = self.width - (differs.bit_length() + 7) // 8
        made, above, key, node = [text, []], None, 0, self.root
        while len(node) == 3 and node[0] < place:
            above, key = node, text[node[0]]
            node = node[1][key]
        if len(node) == 3 and node[0] == place:
            node[1][text[place]] = made
            return made
        branch = [place, {text[place]: made, other[place]: node}, None]
        if above is None:
            self.root = branch
        else:
            above[1][key] = branch
        return made

    def leaves(self) -> Iterator[list]:
        """All leaves in ascending order of their strings."""
        todo = [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if len(node) == 3:
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node


def equal_windows(data: bytes, at: np.ndarray, width: int, shallow: int) -> Iterator[list[int]]:
    """Members (numbers in ``at``) of each set of two or more equal windows, in suffix order."""
    array = np.frombuffer(data + bytes(8), np.uint8)
    for group in shallow_groups(array, at, min(shallow, width) // 8 * 8):
        trie = BlindTrie(width)
        for i, p in zip(group.tolist(), at[group].tolist()):
            trie.leaf(data[p:p + width])[1].append(i)
        for _, members in trie.leaves():
            if len(members) > 1:
                yield members


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes, starts = octets(texts, b"")
    return codes.astype(np.uint64) + np.uint64(1), starts - np.arange(len(starts))


def pieces(text: str, where: list[tuple[int, int]]) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[p:p + n] for p, n in where]


def decider(width: int, shallow: int, shard_bytes: int):
    def run(frames):
        import pyarrow as pa
        for _, texts, docs, rows, places, sizes, starts in S.shards(frames, shard_bytes):
            base = np.concatenate(([0], np.cumsum([len(t) for t in texts])))[:-1]
            n = np.array(sizes)
            owner = np.repeat(np.arange(len(texts)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc, pos = np.array(docs, np.int64)[owner], np.array(places, np.int64)[owner] + step
            gone = []
            for members in equal_windows(b"".join(texts), base[owner] + step, width, shallow):
                least = min(members, key=lambda i: (doc[i], pos[i]))
                gone += [i for i in members if (doc[i], pos[i]) > (doc[least], pos[least])]
            gone = np.sort(np.array(gone, np.int64))  # windows of a passage are numbered in order
            new = np.flatnonzero(np.concatenate(([True], (np.diff(gone) != 1) | (np.diff(owner[gone]) != 0)))) if len(gone) else gone
            yield pa.RecordBatch.from_arrays([pa.array(doc[gone[new]]), pa.array(np.array(rows, np.int64)[owner[gone[new]]]), pa.array(pos[gone[new]]),
                                              pa.array(np.diff(np.append(new, len(gone)))),
                                               pa.array(np.array(starts, np.int64)[owner[gone[new]]])], ["doc_id", "row", "pos", "n", "run"])
    return run


def remove_repeats(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                   shallow: int = SHALLOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, ``n_bytes``, ``n_removed``,
    ``kept`` (the remaining bytes) and ``spans`` (removed bytes as (start, end)).

    Texts are UTF-8.  Each byte inside a string of ``width`` bytes that starts
    earlier too (a smaller id, or a smaller start in the same document, with or
    without overlap) goes; strings are judged on the input.  What remains may
    split a character, so it is binary.  Null and empty texts have no bytes.  A
    null id is larger than any other.  Rows of equal id (as repeated rows) are
    judged as one document read twice from its start, each by its own text.  Empty table: no
    rows.  Other columns are not read.
    """
    read = keyed(docs.select(S.ordered_id(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    spans = S.recurring(read, cut, pieces, decider(width, shallow, shard_bytes), width=width, k=min(K, width), same_document=True)

    def run(frames):
        import pyarrow as pa
        for got in batches(frames, ["doc_id", "text", "spans"]):
            out = []
            for text, found in zip(got["text"], got["spans"]):
                data = text.encode("utf-8", "surrogatepass")
                gone = S.covered(found or [], len(data))
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept), kept, [{"start": a, "end": b} for a, b in gone]))
            n, gone, kept, where = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d if d != S.LAST_ID else None for d in got["doc_id"]], pa.int64()), pa.array(n, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(where, S.span_type())],
                ["doc_id", "n_bytes", "n_removed", "kept", "spans"])
    return S.with_spans(read, spans).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:long,end:long>>")
