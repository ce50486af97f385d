"""Language identification of whole, possibly mixed, texts.

Each word is narrowed to the languages whose training text uses its script
(by code point ranges) and scored per language by its character n-grams.  A
Viterbi pass over the words of a document, with a penalty for each switch of
language, labels spans; the document's language is the one whose spans hold
the most letters, and its score is their share.

The labelled rows are counted per language over the whole table, and every language is learnt:
from all of its rows, or from about ``SAMPLE_ROWS`` of them (those whose hash is
below the share that this is of the language's rows).  n-grams are counted in tasks; every
text is labelled whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import batches, characters, is_space, kept, letters, mixed, runs, span_hashes

#: Labelled rows of each language.
SAMPLE_ROWS = 8000
#: Hashed n-gram buckets of each language.
BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
#: Log-likelihood that a change of language must win.
SWITCH = 12.0
#: A script is a candidate's if at least this share of its letters is in it.
SCRIPT_SHARE = 0.001
UNDETERMINED = "und"
# The first code point of each range, and its script (block ranges of Unicode).
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0750, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Other"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Burmese"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C00, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"),
    (0x3200, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0x10000, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


def script_of(codes: np.ndarray) -> np.ndarray:
    at = np.array([a for a, _ in SCRIPTS])
    kind = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS], np.int8)
    return kind[np.searchsorted(at, codes, "right") - 1]


def lower_table() -> np.ndarray:
    return kept("lower", lambda: np.fromiter(
        (ord(low) if len(low := chr(c).lower()) == 1 else c for c in range(0x10000)), np.uint32, 0x10000))


class Words:
    """The words of a batch that hold a letter, and their distinct spellings.

    ``spelt`` has each distinct word once, lower-cased, with one blank before and
    after it; whatever is not a letter is a blank too, as digits and signs tell
    no language."""

    def __init__(self, texts: list[str]):
        codes, self.starts = characters(texts)
        low = np.where(codes < 0x10000, lower_table()[np.minimum(codes, 0xFFFF)], codes)
        letter = letters(codes)
        symbols = np.where(letter, low, np.uint32(32))
        ws, we = runs(~is_space(codes))
        at = np.concatenate(([0], np.cumsum(letter)))
        n_letters = at[we] - at[ws]
        has = n_letters > 0
        self.ws, self.we, self.n_letters = ws[has], we[has], n_letters[has]
        self.doc = np.searchsorted(self.starts, self.ws, "right") - 1
        _, pick, self.word, self.times = np.unique(span_hashes(symbols, self.ws, self.we), return_index=True,
                                                   return_inverse=True, return_counts=True)
        size = (self.we - self.ws)[pick]
        self.at = np.concatenate(([0], np.cumsum(size + 2)))
        self.spelt = np.full(self.at[-1], 32, np.uint32)
        inner = np.arange(size.sum()) - np.repeat(np.concatenate(([0], np.cumsum(size)))[:-1], size)
        self.spelt[np.repeat(self.at[:-1] + 1, size) + inner] = symbols[np.repeat(self.ws[pick], size) + inner]
        first = np.flatnonzero(letter)
        self.script = script_of(codes[first[np.searchsorted(first, self.ws[pick])]]) if len(pick) else np.zeros(0, np.int8)

    def grams(self, k: int) -> np.ndarray:
        """Bucket of the n-gram that starts at each place of ``spelt``;
        BUCKETS where it would leave the word."""
        s = self.spelt
        n = len(s) - k + 1
        bucket = np.full(len(s), BUCKETS, np.int32)
        if n <= 0:
            return bucket
        key = np.full(n, k, np.uint64)
        for j in range(k):
            key = key * np.uint64(0x1F123BB5) + s[j:j + n]
        bucket[:n] = mixed(key) % np.uint64(BUCKETS)
        end = np.repeat(self.at[1:], np.diff(self.at))
        bucket[np.arange(len(s)) + k > end] = BUCKETS
        return bucket


def counts(texts: list[str], labels: np.ndarray, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per language: n-gram buckets by order, and words by script."""
    grams = np.zeros((len(GRAMS), n_langs, BUCKETS), np.int64)
    scripts = np.zeros((n_langs, len(SCRIPT_NAMES)), np.int64)
    for lang in np.unique(labels):
        w = Words([t for t, x in zip(texts, labels) if x == lang])
        if not len(w.ws):
            continue
        times = np.repeat(w.times, np.diff(w.at))
        for g, k in enumerate(GRAMS):
            grams[g, lang] += np.bincount(w.grams(k), weights=times, minlength=BUCKETS + 1)[:BUCKETS].astype(np.int64)
        scripts[lang] += np.bincount(w.script, weights=w.times, minlength=len(SCRIPT_NAMES)).astype(np.int64)
    return grams, scripts


def model_of(grams: np.ndarray, scripts: np.ndarray) -> dict:
    """Log-probabilities per n-gram and the languages of each script."""
    smooth = grams + 0.1
    tables = np.log(smooth / smooth.sum(2, keepdims=True)).transpose(0, 2, 1)
    tables = tables - tables.mean(2, keepdims=True)
    tables = np.concatenate([tables, np.zeros_like(tables[:, :1])], 1).astype(np.float32)
    share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
    allowed = (share >= SCRIPT_SHARE).T
    allowed |= ~allowed.any(1, keepdims=True)  # a script that no training text uses excludes nobody
    return {"tables": np.ascontiguousarray(tables), "bar": np.where(allowed, 0, -1e4).astype(np.float32)}


def word_scores(w: Words, model: dict) -> np.ndarray:
    """Score of each word in each language: mean over the orders of the sums over its n-grams."""
    total = sum(np.take(model["tables"][g], w.grams(k), axis=0) for g, k in enumerate(GRAMS))
    distinct = np.add.reduceat(total, w.at[:-1], axis=0) / np.float32(len(GRAMS))
    return (distinct + model["bar"][w.script])[w.word]


def viterbi(scores: np.ndarray, first: np.ndarray, length: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word, all documents of the batch a step at a time."""
    n_langs = scores.shape[1]
    kind = np.int8 if n_langs < 128 else np.int32
    label = np.zeros(len(scores), kind)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    if not len(order):
        return label
    first, length = first[order], length[order]
    back = np.empty((len(scores), n_langs), kind)
    own = np.arange(n_langs, dtype=kind)
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # documents longer than t
    best = scores[first].copy()
    final = np.empty((len(order), n_langs), np.float32)
    for t in range(1, length[0]):
        a = active[t]
        if a < len(best):
            final[a:len(best)] = best[a:]
            best = best[:a]
        at = first[:a] + t
        top = best.argmax(1)
        change = best[np.arange(a), top] - switch
        stay = best >= change[:, None]
        back[at] = np.where(stay, own, top[:, None].astype(kind))
        best = np.where(stay, best, change[:, None]) + scores[at]
    final[:len(best)] = best
    state = final.argmax(1).astype(kind)
    for t in range(length[0] - 1, 0, -1):
        a = active[t]
        at = first[:a] + t
        label[at] = state[:a]
        state[:a] = back[at, state[:a]]
    label[first] = state
    return label


def label_batch(texts: list[str], model: dict, switch: float) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """Language number (-1: no letters) and share of each text; its words and their languages."""
    w = Words(texts)
    n, n_langs = len(texts), model["tables"].shape[2]
    length = np.bincount(w.doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(length)))[:-1]
    if len(w.ws):
        label = viterbi(word_scores(w, model), first, length, switch)
    else:
        label = np.zeros(0, np.int8)
    held = np.bincount(w.doc * n_langs + label, weights=w.n_letters, minlength=n * n_langs).reshape(n, n_langs)
    total = held.sum(1)
    best = np.where(total > 0, held.argmax(1), -1)
    return best, np.where(total > 0, held.max(1) / np.maximum(total, 1), 0.0), w, label


def spans_of(w: Words, label: np.ndarray, langs: list[str], n: int) -> list[list[dict]]:
    """Maximal runs of words of one language, in characters of each text."""
    out: list[list[dict]] = [[] for _ in range(n)]
    if not len(label):
        return out
    new = np.flatnonzero(np.concatenate(([True], (np.diff(label) != 0) | (np.diff(w.doc) != 0))))
    end = np.concatenate((new[1:], [len(label)])) - 1
    base = w.starts[w.doc[new]]
    for d, s, e, k in zip(w.doc[new], w.ws[new] - base, w.we[end] - base, label[new]):
        out[d].append({"start": int(s), "end": int(e), "lang": langs[k]})
    return out


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[dict | None, list[str]]:
    """The model of labelled ``docs`` (doc_id, text, lang) and its languages;
    None without any."""
    rows = dict(docs.where("lang IS NOT NULL").groupBy("lang").count().collect())  # a row a language, as the model has a table
    langs = sorted(rows)
    if not langs:
        return None, []
    number = {x: i for i, x in enumerate(langs)}
    last = (1 << 63) - 1
    below = [(x, last if n <= sample_rows else (sample_rows << 64) // n - (1 << 63)) for x, n in rows.items()]
    taken = F.broadcast(docs.sparkSession.createDataFrame(below, "lang string, below long"))
    texts = docs.join(taken, "lang").where(F.xxhash64("doc_id", "text", F.lit(4)) <= F.col("below")).select("lang", "text")
    n_langs, n_scripts = len(langs), len(SCRIPT_NAMES)

    def run(frames):
        import pyarrow as pa
        grams = np.zeros((len(GRAMS), n_langs, BUCKETS), np.int64)
        scripts = np.zeros((n_langs, n_scripts), np.int64)
        for got in batches(frames, ["lang", "text"]):
            g, s = counts(got["text"], np.array([number[x] for x in got["lang"]]), n_langs)
            grams += g
            scripts += s
        flat = np.concatenate([grams.ravel(), scripts.ravel()])
        at = np.flatnonzero(flat)
        for k in range(0, len(at), 100_000):
            part = at[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(flat[part])], ["at", "n"])
    summed = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    flat = np.zeros(len(GRAMS) * n_langs * BUCKETS + n_langs * n_scripts, np.int64)
    flat[summed["at"].to_numpy()] = summed["n"].to_numpy()
    cut = len(GRAMS) * n_langs * BUCKETS
    return model_of(flat[:cut].reshape(len(GRAMS), n_langs, BUCKETS), flat[cut:].reshape(n_langs, n_scripts)), langs


def identify(docs: DataFrame, training: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             switch: float = SWITCH, sample_rows: int = SAMPLE_ROWS, spans: bool = True) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, ``lang_pred``, ``score`` (share of
    the letters in spans of that language) and, on request, ``spans`` of
    (start, end, lang) in characters.

    ``training`` has doc_id, text and lang.  A text that is null, empty or
    without letters is ``und`` with score 0, as is every text when no training
    row has a language.  Ties go to the first language in alphabetical order.  Repeated
    rows are labelled each time.  Empty tables: no rows.  Other columns are
    not read.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model, langs = train(training.select("doc_id", F.col("text").cast("string").alias("text"), "lang"), sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = read.schema["doc_id"].dataType
    out = f"doc_id {kind.simpleString()}, lang_pred string, score double"
    if spans:
        out += ", spans array<struct<start:int,end:int,lang:string>>"

    def run(frames):
        import pyarrow as pa
        model = shared.value
        for got in batches(frames, ["doc_id", "text"], size=3_000_000):
            n = len(got["text"])
            if model is None:
                best, share, w, label = np.full(n, -1), np.zeros(n), None, np.zeros(0)
            else:
                best, share, w, label = label_batch(got["text"], model, switch)
            cols = [pa.array(got["doc_id"], id_type), pa.array([langs[b] if b >= 0 else UNDETERMINED for b in best]), pa.array(share)]
            if spans:
                cols.append(pa.array(spans_of(w, label, langs, n), span_type))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "lang_pred", "score", "spans"][:len(cols)])
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    from pyspark.sql.types import StructType
    id_type = to_arrow_type(kind)
    span_type = to_arrow_schema(StructType.fromDDL(out)).field("spans").type if spans else None
    return read.mapInArrow(run, out)
