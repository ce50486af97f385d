"""Cost-balanced sequence packing.

Every document is tokenised, gets an end id, and is laid into sequences
of ``capacity`` ids.  The cost of a piece of ``n`` ids is
``linear * n + quadratic * n * n`` (feed-forward and attention work); the
pieces of a block are taken in descending length and each goes to the
sequence of lowest cost that still has room for it.  When none has room for
the whole piece, the lowest-cost sequence that is not yet full takes the
head of it and the rest is placed next.

A block is a run of documents of one input partition, about
``block_tokens`` ids, so that a task holds one block and nothing is
shuffled: the work follows the input splits at any scale.  The capacities
of a block add up to exactly its ids: full sequences, and one sequence for
each power of two in the remainder.  No sequence therefore has padding
beyond its own power of two.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame

from .vectors import batches, give_back

PIECES = ("doc_id {id_type}, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")
#: Ids of one block; a block's documents are held in memory by one task.
BLOCK_TOKENS = 1 << 22
#: Words whose ids a task remembers at most.
CACHE_WORDS = 1 << 20
#: Longer words are left to the tokenizer; so many of the others are compared with it.
LONG_WORD, PROBED = 200, 50
#: Characters of a text that are coded at a time, and those that a task codes both ways.
SLICE_CHARS, PROBED_CHARS = 100_000, 10_000
#: Characters of texts, and pieces, that are Python values at a time.
TEXT_CHARS, PIECES_OUT = 500_000, 1024
# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class WordIds(dict):
    """Ids of words that each follow a blank, as little-endian unsigned
    32-bit bytes; a new word is merged by rank, or left to the tokenizer if it is
    long or has white space in it.  The first words are coded both ways and must agree."""

    BLANK = re.compile(r"\s")

    def __init__(self, tokenizer, by_rank):
        self.tokenizer, self.by_rank, self.probes = tokenizer, by_rank, PROBED

    def slow(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if self.by_rank is None or len(word) > LONG_WORD or self.BLANK.search(word):
            found = self.slow(" " + word)
        else:
            found = array("I", self.by_rank(" " + word)).tobytes()
            if self.probes:
                self.probes -= 1
                if found != self.slow(" " + word):
                    raise RuntimeError("merging by rank disagrees with the tokenizer")
        self[word] = found
        return found


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary's pre-tokeniser never joins what lies before and after a
    single blank between two non-blank characters, so a text may be cut there.  Texts are merged
    by rank, in slices of some ``SLICE_CHARS``; parts that are long or have other white space than
    ASCII's are left to the tokenizer.  The first slices are coded both ways and must agree.  Of
    vocabularies that are not merged by rank, the ids of each part are remembered, up to ``cache_words``."""

    LOOSE = re.compile(r"\s | \s|^ | $")
    CUT = re.compile(r"(?<=\S) (?=\S)")
    OTHER = re.compile(r"[^\S \t-\r]")

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        self.cache_words, self.probes = cache_words, PROBED_CHARS
        self.known = WordIds(tokenizer, rank_encoder(path))

    def parts(self, text: str) -> list[str]:
        """The first part, then parts that each follow one blank."""
        return self.CUT.split(text) if self.LOOSE.search(text) else text.split(" ")

    def encode(self, text: str) -> bytes:
        if self.known.by_rank is not None:
            return b"".join(map(self.merged, self.slices(text)))
        if len(self.known) > self.cache_words:
            self.known.clear()
        first, *rest = self.parts(text)
        return self.known.slow(first) + b"".join(map(self.known.__getitem__, rest))

    def slices(self, text: str) -> Iterator[str]:
        """The text in slices that, but for the first, begin with the blank they are cut at."""
        at = 0
        while len(text) - at > SLICE_CHARS and (cut := self.CUT.search(text, at + SLICE_CHARS)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def merged(self, text: str) -> bytes:
        if self.OTHER.search(text) or self.has_long(text):
            return b"".join(self.apart(text))
        found = array("I", self.known.by_rank(text)).tobytes()
        if self.probes > 0:
            probe = text if len(text) <= self.probes else text[:cut.start()] if (cut := self.CUT.search(text, self.probes)) else ""
            self.probes -= max(len(probe), 1)
            if not found.startswith(self.known.slow(probe)):
                raise RuntimeError("merging by rank disagrees with the tokenizer")
        return found

    @staticmethod
    def has_long(text: str) -> bool:
        """Whether more than ``LONG_WORD`` characters lie between two blanks."""
        at = 0
        while len(text) - at > LONG_WORD:
            at = text.rfind(" ", at, at + LONG_WORD + 1) + 1
            if not at:
                return True
        return False

    def apart(self, text: str) -> Iterator[bytes]:
        """The ids of long parts and those with other white space by the tokenizer, of what is between them by rank."""
        cuts, done = [0, *(m.start() for m in self.CUT.finditer(text)), len(text)], 0
        for a, b in zip(cuts, cuts[1:]):
            if b - a > LONG_WORD + 1 or self.OTHER.search(text, a, b):
                yield array("I", self.known.by_rank(text[done:a])).tobytes() + self.known.slow(text[a:b])
                done = b
        yield array("I", self.known.by_rank(text[done:])).tobytes()


def rank_encoder(path: str):
    """The vocabulary of a byte-level BPE file for merging by rank, which is
    several times as fast on new words; None for other tokenizers."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if (model.get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("dropout")):
        return None
    import tiktoken
    # byte-level BPE writes a byte as its own character if printable, else as one from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class OpenSequences:
    """Sequences with room left: the one of lowest cost among those with at
    least ``n`` free ids, by a tournament over the free room."""

    NONE = (float("inf"), -1)

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]
        self.tree = [self.NONE] * (2 * self.size)

    def _refresh(self, room: int) -> None:
        tree, node = self.tree, self.size + room
        heap = self.heaps[room]
        tree[node] = heap[0] if heap else self.NONE
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a <= b else b
            if tree[node] == best:
                break
            tree[node] = best

    def add(self, room: int, cost: float, seq: int) -> None:
        heapq.heappush(self.heaps[room], (cost, seq))
        self._refresh(room)

    def take(self, need: int) -> tuple[int, float, int] | None:
        """Remove and return (room, cost, sequence) of lowest cost with room for ``need``."""
        lo, hi, best, at = self.size + need, 2 * self.size, self.NONE, 0
        tree = self.tree
        while lo < hi:
            if lo & 1:
                if tree[lo] < best:
                    best, at = tree[lo], lo
                lo += 1
            if hi & 1:
                hi -= 1
                if tree[hi] < best:
                    best, at = tree[hi], hi
            lo >>= 1
            hi >>= 1
        if not at:
            return None
        while at < self.size:
            at = 2 * at if tree[2 * at] == best else 2 * at + 1
        room = at - self.size
        cost, seq = heapq.heappop(self.heaps[room])
        self._refresh(room)
        return room, cost, seq


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) of one block and the
    capacity of each of its sequences."""
    total = sum(lengths)
    rest = total % capacity
    sizes = [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    pieces, left, seq, full = [], [], 0, total // capacity
    for d, n in enumerate(lengths):
        whole = min(n // capacity, full - seq)
        for k in range(whole):
            pieces.append((d, k * capacity, capacity, seq, 0))
            seq += 1
        if n > whole * capacity:
            left.append((n - whole * capacity, d, whole * capacity))
    room = OpenSequences(capacity)
    for s in range(seq, len(sizes)):
        room.add(sizes[s], 0.0, s)
    left.sort(key=lambda x: (-x[0], x[1]))
    for n, d, start in left:
        while n:
            found = room.take(min(n, capacity)) or room.take(1)
            free, cost, s = found
            k = min(n, free)
            pieces.append((d, start, k, s, sizes[s] - free))
            if free > k:
                room.add(free - k, cost + linear * k + quadratic * k * k, s)
            n -= k
            start += k
    return pieces, sizes


def _pieces(frames: Iterator, encoder: WordEncoder, schema, next_id: int, capacity: int, end_id: int, linear: float,
            quadratic: float, block_tokens: int) -> Iterator:
    """Arrow batches of pieces.  Beside one block's ids, a task holds few texts and few pieces as Python values."""
    import pyarrow as pa

    end = int(end_id).to_bytes(4, "little")
    give_back()  # what the vocabulary was read with
    ids, coded, held = [], [], 0

    def flush():
        nonlocal ids, coded, held, next_id
        pieces, sizes = assign([len(c) // 4 for c in coded], capacity, linear, quadratic)
        for at in range(0, len(pieces), PIECES_OUT):
            part = pieces[at:at + PIECES_OUT]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((
                [ids[p[0]] for p in part], [p[1] for p in part], [p[2] for p in part],
                [coded[p[0]][4 * p[1]:4 * (p[1] + p[2])] for p in part], [len(coded[p[0]]) // 4 for p in part],
                [next_id + p[3] for p in part], [p[4] for p in part], [sizes[p[3]] for p in part]), schema.types)], schema=schema)
        next_id += len(sizes)
        ids, coded, held = [], [], 0
        give_back()

    for got in batches(frames, ["doc_id", "text"], size=TEXT_CHARS):
        for name, text in zip(got["doc_id"], got["text"]):
            ids.append(name)
            coded.append(encoder.encode(text) + end)
            held += len(coded[-1]) // 4
            if held >= block_tokens:
                yield from flush()
    if ids:
        yield from flush()


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, end_id: int = 0, linear: float = 1.0,
         quadratic: float = 1.0 / 1024, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id",
         text_col: str = "text", cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of the document before
    it), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``
    (with the end id), ``sequence_id``, ``offset`` (of the piece in its
    sequence, gapless from 0) and ``sequence_tokens`` (ids in the sequence).

    A null or empty text is the end id alone.  Each row of a repeated row is
    a document of its own.  A null id stays null.  An empty table has no
    pieces.  Other columns are not read.  A document longer than a block makes
    a block of its own.  Ties in length go by the input order; a retried
    task reads the same split and packs it alike.
    """
    def run(frames: Iterator) -> Iterator:
        yield from _pieces(frames, WordEncoder(tokenizer_path, cache_words), schema, TaskContext.get().partitionId() << 40,
                           capacity, end_id, linear, quadratic, block_tokens)

    from pyspark.sql.pandas.types import to_arrow_schema
    picked = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    out = PIECES.format(id_type=picked.schema["doc_id"].dataType.simpleString())
    schema = to_arrow_schema(_schema(out))
    return picked.mapInArrow(run, out)


def _schema(ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)
