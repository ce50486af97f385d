"""Removal of word sequences that an earlier document has.

Passages that recur are gathered into reference shards (see
``shared_runs``).  In a shard, passages are taken in ascending document order: each
document's passages are streamed through a suffix automaton of all earlier
documents' passages, which gives the length of the longest match ending at each
word (matching statistics); a match of ``width`` words or more marks that
window.  Then the document's passages are added to the automaton.  A shard holds
at most about ``SHARD_BYTES`` of passages and what one anchor has besides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared_runs as S
from .common import keyed
from .vectors import batches, is_space, octets, runs, span_hashes

WIDTH = 13
#: Words of an anchor.
K = 5
SHARD_BYTES = 1 << 19


class Automaton:
    """Suffix automaton of several word sequences, extended one word at a time."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            have = nxt[last].get(w)
            if have is not None and length[have] == length[last] + 1:
                last = have  # an earlier sequence has made this state
                continue
            if have is not None:
                last = self._split(last, w, have)
                continue
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p != -1:
                q = nxt[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
            last = new

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of state q for the shorter strings that p leads to by w."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def matches(self, words: list[int]) -> Iterator[int]:
        """For each word, the length of the longest match that ends with it."""
        nxt, link, length = self.next, self.link, self.length
        state = n = 0
        for w in words:
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(w)
            if to is not None:
                state, n = to, n + 1
            yield n


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words before each text."""
    codes, starts = octets(texts)
    ws, we = runs(~is_space(codes))
    return span_hashes(codes, ws, we), np.searchsorted(ws, starts)


def pieces(text: str, where: list[tuple[int, int]]) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").split()
    return [b" ".join(words[p:p + n]) for p, n in where]


def decider(width: int, shard_bytes: int):
    def run(frames):
        import pyarrow as pa
        for _, texts, docs, rows, places, _, starts in S.shards(frames, shard_bytes):
            number: dict[bytes, int] = {}
            coded = [[number.setdefault(w, len(number)) for w in t.split(b" ")] for t in texts]
            order = sorted(range(len(docs)), key=docs.__getitem__)
            automaton, at, out = Automaton(), 0, []
            while at < len(order):
                to = at
                while to < len(order) and docs[order[to]] == docs[order[at]]:
                    to += 1
                same = order[at:to]
                for i in same:
                    last = -2
                    for j, n in enumerate(automaton.matches(coded[i])):
                        if n >= width:
                            if j == last + 1:  # the window after the previous one
                                out[-1][3] += 1
                            else:
                                out.append([docs[i], rows[i], places[i] + j - width + 1, 1, starts[i]])
                            last = j
                for i in same:
                    automaton.add(coded[i])
                at = to
            cols = list(zip(*out)) or [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "row", "pos", "n", "run"])
    return run


def remove_repeats(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, ``n_words``, ``n_removed``, ``text``
    (kept words joined by one blank) and ``spans`` (removed words as (start, end)).

    Words lie between ASCII white space.  Each word inside a window of ``width`` words that a
    document of smaller id has too goes; windows are judged on the input.
    Null and empty texts have no words.  A null id is larger than any other.
    Rows of equal id (as repeated rows) do not repeat each other, and each is judged
    by its own text against smaller ids.  Empty table: no rows.  Other columns are not read.
    """
    read = keyed(docs.select(S.ordered_id(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    spans = S.recurring(read, cut, pieces, decider(width, shard_bytes), width=width, k=min(K, width), same_document=False)

    def run(frames):
        import pyarrow as pa
        for got in batches(frames, ["doc_id", "text", "spans"]):
            out = []
            for text, found in zip(got["text"], got["spans"]):
                words = text.encode("utf-8", "surrogatepass").split()
                gone = S.covered(found or [], len(words))
                kept, at = [], 0
                for a, b in gone:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass"),
                            [{"start": a, "end": b} for a, b in gone]))
            n, gone, text, where = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d if d != S.LAST_ID else None for d in got["doc_id"]], pa.int64()), pa.array(n, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(text), pa.array(where, S.span_type())],
                ["doc_id", "n_words", "n_removed", "text", "spans"])
    return S.with_spans(read, spans).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, text string, spans array<struct<start:long,end:long>>")
