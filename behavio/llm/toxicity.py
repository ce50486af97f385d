"""Toxicity of whole texts by a small recurrent network.

A text is scored in all overlapping windows of ``WINDOW`` words, one every
``STRIDE`` words, and gets the highest window score.  In a window each word
enters as its own embedding (by hash) joined with the mean embedding of its
character n-grams; a gated recurrent network reads the words in both
directions, attention pools its states, and a logistic unit scores the pool.
All of it, gradients included, is numpy.

Training takes at most ``SAMPLE_ROWS`` labelled rows of each class, those of
smallest id hash among the texts of at most ``TRAIN_CHARS`` characters.  A label
holds for a text, so each step trains on the text's window that scores highest
at that time (multiple-instance learning).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import batches, characters, is_space, kept, letters, mixed, runs, span_hashes

SAMPLE_ROWS = 2500
WINDOW, STRIDE = 24, 12
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 14
#: Character n-grams of a word with a blank before and after it.
ORDERS = (3, 4)
TRAIN_CHARS = 6000


class Spelling:
    """Distinct words of a batch, their buckets and n-gram buckets."""

    def __init__(self, texts: list[str]):
        codes, self.starts = characters(texts)
        low = np.where(codes < 0x10000, kept("lower", lower_table)[np.minimum(codes, 0xFFFF)], codes)
        inside = ~is_space(codes)
        letter = letters(codes) & inside
        ws, we = runs(letter)
        self.n_texts = len(texts)
        self.doc = np.searchsorted(self.starts, ws, "right") - 1
        hashes, pick, self.word = np.unique(span_hashes(low, ws, we), return_index=True, return_inverse=True)
        self.bucket = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int32)
        size = (we - ws)[pick]
        self.at = np.concatenate(([0], np.cumsum(size + 2)))
        spelt = np.full(self.at[-1], 32, np.uint64)
        inner = np.arange(size.sum()) - np.repeat(np.concatenate(([0], np.cumsum(size)))[:-1], size)
        spelt[np.repeat(self.at[:-1] + 1, size) + inner] = low[np.repeat(ws[pick], size) + inner]
        self.spelt = spelt

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, n-gram bucket) of all n-grams of the distinct words, by word."""
        n = len(self.spelt)
        owner = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        end = self.at[1:][owner]
        words, found = [], []
        for k in ORDERS:
            m = max(n - k + 1, 0)
            key = np.full(m, k, np.uint64)
            for j in range(k):
                key = key * np.uint64(0x1F123BB5) + self.spelt[j:j + m]
            ok = np.arange(m) + k <= end[:m]
            words.append(owner[:m][ok])
            found.append((mixed(key[ok]) % np.uint64(CHAR_BUCKETS)).astype(np.int32))
        w, g = np.concatenate(words), np.concatenate(found)
        order = np.argsort(w, kind="stable")
        return w[order], g[order]


def lower_table() -> np.ndarray:
    return np.fromiter((ord(low) if len(low := chr(c).lower()) == 1 else c for c in range(0x10000)), np.uint32, 0x10000)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def new_net(seed: int = 11) -> dict:
    rng = np.random.default_rng(seed)
    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    net = {"word": rng.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM)), "char": rng.normal(0, 0.1, (CHAR_BUCKETS, CHAR_DIM))}
    for way in "fb":
        net["w" + way] = rng.normal(0, 1 / np.sqrt(d), (d, 3 * h))
        net["u" + way] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
        net["c" + way] = np.zeros(3 * h)
    net |= {"aw": rng.normal(0, 0.5, (2 * h, h)), "ab": np.zeros(h), "av": rng.normal(0, 0.5, h),
            "ow": rng.normal(0, 0.5, 2 * h), "ob": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in net.items()}


def word_inputs(net: dict, bucket: np.ndarray, words: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Input vector of each distinct word."""
    n = len(bucket)
    total = np.zeros((n, CHAR_DIM), np.float32)
    if len(words):
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        sums = np.add.reduceat(net["char"][grams], first, axis=0)
        total[words[first]] = sums / np.diff(np.concatenate((first, [len(words)])))[:, None]
    return np.concatenate([net["word"][bucket], total], 1)


def recur(pre: np.ndarray, ids: np.ndarray, valid: np.ndarray, u: np.ndarray, back: bool, keep: list | None) -> np.ndarray:
    """States of the gated network over (time, window); ``pre`` has the input part of each distinct word."""
    steps, n = ids.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    two = 2 * HIDDEN
    for t in range(steps - 1, -1, -1) if back else range(steps):
        x = pre[ids[t]]
        gates = sigmoid(x[:, :two] + h @ u[:, :two])
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        rec = h @ u[:, two:]
        cand = np.tanh(x[:, two:] + r * rec)
        new = h + z * (cand - h)
        new = np.where(valid[t][:, None], new, h)
        if keep is not None:
            keep.append((t, h, r, z, cand, rec))
        h = out[t] = new
    return out


def attend(net: dict, states: np.ndarray, valid: np.ndarray):
    hid = np.tanh(states @ net["aw"] + net["ab"])
    e = np.where(valid, hid @ net["av"], np.float32(-1e9))
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pool = np.einsum("tn,tnd->nd", a, states)
    return hid, a, pool, pool @ net["ow"] + net["ob"][0]


def window_logits(net: dict, x: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Logit of each window; ids and valid are (time, window)."""
    states = np.concatenate([recur(x @ net["w" + w] + net["c" + w], ids, valid, net["u" + w], w == "b", None) for w in "fb"], 2)
    return attend(net, states, valid)[3]


def gradients(net: dict, x: np.ndarray, ids: np.ndarray, valid: np.ndarray, target: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradient of the mean log loss over windows, by backpropagation through time; also by x."""
    n, two = ids.shape[1], 2 * HIDDEN
    keeps: dict[str, list] = {"f": [], "b": []}
    pre = {w: x @ net["w" + w] + net["c" + w] for w in "fb"}
    states = np.concatenate([recur(pre[w], ids, valid, net["u" + w], w == "b", keeps[w]) for w in "fb"], 2)
    hid, a, pool, logit = attend(net, states, valid)
    g = {k: np.zeros_like(v) for k, v in net.items() if k not in ("word", "char")}
    d = (sigmoid(logit) - target) / n
    g["ow"], g["ob"] = pool.T @ d, d.sum(keepdims=True)
    dpool = d[:, None] * net["ow"]
    dstates = a[:, :, None] * dpool
    da = np.einsum("tnd,nd->tn", states, dpool)
    de = a * (da - (a * da).sum(0))
    dhid = de[:, :, None] * net["av"] * (1 - hid ** 2)
    g["av"] = np.einsum("tn,tnh->h", de, hid)
    g["aw"] = np.einsum("tnd,tnh->dh", states, dhid)
    g["ab"] = dhid.sum((0, 1))
    dstates = dstates + dhid @ net["aw"].T
    dx = np.zeros_like(x)
    for w, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
        u, dh = net["u" + w], np.zeros((n, HIDDEN), np.float32)
        dpre = np.zeros_like(pre[w])
        for t, h, r, z, cand, rec in reversed(keeps[w]):
            dh = dh + dstates[t][:, part]
            live = valid[t][:, None]
            dn = np.where(live, dh, 0)
            dcand = dn * z * (1 - cand ** 2)
            dz = dn * (cand - h) * z * (1 - z)
            dr = dcand * rec * r * (1 - r)
            dgate = np.concatenate([dr, dz], 1)
            np.add.at(dpre, ids[t], np.concatenate([dgate, dcand], 1))
            g["u" + w][:, :two] += h.T @ dgate
            g["u" + w][:, two:] += h.T @ (dcand * r)
            dh = np.where(live, dn * (1 - z) + dgate @ u[:, :two].T + (dcand * r) @ u[:, two:].T, dh)
        g["w" + w] = x.T @ dpre
        g["c" + w] = dpre.sum(0)
        dx += dpre @ net["w" + w].T
    return g, dx


def windows_of(length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word in the text) of all windows of texts of these lengths; none for an empty text."""
    many = np.where(length > 0, np.maximum(-(-(length - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(length)), many)
    place = np.arange(len(text)) - np.repeat(np.concatenate(([0], np.cumsum(many)))[:-1], many)
    return text, place * STRIDE


def max_by(values: np.ndarray, group: np.ndarray, n: int, fill: float) -> np.ndarray:
    out = np.full(n, fill)
    np.maximum.at(out, group, values)
    return out


def score_texts(net: dict, texts: list[str]) -> np.ndarray:
    """Highest window score of each text; the bias' score for one without words."""
    s = Spelling(texts)
    n = len(texts)
    length = np.bincount(s.doc, minlength=n)
    best = np.full(n, -np.inf)
    if len(s.word):
        words, grams = s.grams()
        x = word_inputs(net, s.bucket, words, grams)
        first = np.concatenate(([0], np.cumsum(length)))[:-1]
        text, place = windows_of(length)
        for at in range(0, len(text), 8192):
            t, p = text[at:at + 8192], place[at:at + 8192]
            step = np.arange(WINDOW)[:, None]
            valid = p + step < length[t]
            ids = s.word[np.where(valid, first[t] + p + step, 0)]
            np.maximum.at(best, t, window_logits(net, x, ids, valid))
    empty = float(net["low"][0])
    return sigmoid(np.where(np.isfinite(best), best, empty))


def train(texts: list[str], labels: np.ndarray, steps: int = 240, batch: int = 64, rate: float = 0.01) -> dict:
    """The network fitted to labelled texts; ``low`` is its logit for a text without words."""
    net = new_net()
    rng = np.random.default_rng(5)
    m, v, step = {}, {}, 0
    rate_of_ones = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    base = np.array([np.log(rate_of_ones / (1 - rate_of_ones)) - 2.0])
    s = Spelling(texts) if texts else None
    if s is None or not len(s.word) or len(set(labels.tolist())) < 2:
        return net | {"ow": net["ow"] * 0, "ob": base.astype(np.float32), "low": base.astype(np.float32)}
    words, grams = s.grams()
    edge = np.searchsorted(words, np.arange(len(s.bucket) + 1))
    own = np.split(s.word, np.cumsum(np.bincount(s.doc, minlength=len(texts)))[:-1])
    while step < steps:
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            length = np.array([len(own[i]) for i in rows])
            step += 1
            if not length.sum():
                continue
            used, local = np.unique(np.concatenate([own[i] for i in rows]), return_inverse=True)
            size = edge[used + 1] - edge[used]
            spots = np.repeat(edge[used] - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(size.sum())
            lw, lg = np.repeat(np.arange(len(used)), size), grams[spots]
            x = word_inputs(net, s.bucket[used], lw, lg)
            first = np.concatenate(([0], np.cumsum(length)))[:-1]
            text, place = windows_of(length)
            grid = np.arange(WINDOW)[:, None]
            valid = place + grid < length[text]
            ids = local[np.where(valid, first[text] + place + grid, 0)]
            logit = window_logits(net, x, ids, valid)
            top = np.lexsort((-logit, text))
            top = top[np.concatenate(([True], np.diff(text[top]) > 0))]
            g, dx = gradients(net, x, ids[:, top], valid[:, top], labels[rows][text[top]].astype(np.float32))
            g["word"], g["char"] = np.zeros_like(net["word"]), np.zeros_like(net["char"])
            np.add.at(g["word"], s.bucket[used], dx[:, :WORD_DIM])
            np.add.at(g["char"], lg, (dx[:, WORD_DIM:] / np.maximum(size, 1)[:, None])[lw])
            for k in g:
                m[k] = 0.9 * m.get(k, 0) + 0.1 * g[k]
                v[k] = 0.99 * v.get(k, 0) + 0.01 * g[k] ** 2
                net[k] = (net[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net | {"low": base}


def score(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, ``score`` (0 to 1).

    ``labelled`` has doc_id and label (0 or 1; other and null labels are not
    used).  A text that is null, empty or without letters has the score of a
    low prior.  A repeated row is scored each time and trains once.  With one
    class or none to learn from, every score is that prior.  Empty tables: no
    rows.  Other columns are not read.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labelled.select("doc_id", "label").where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    short = read.where(F.length("text") <= TRAIN_CHARS).join(known, "doc_id").select("doc_id", "label")
    at = F.xxhash64("doc_id", F.lit(6))
    some = short.where("label = 1").orderBy(at, "doc_id").limit(sample_rows).unionByName(
        short.where("label = 0").orderBy(at, "doc_id").limit(sample_rows)).distinct()
    # at most 2 * sample_rows ids (broadcast by that bound), and so many texts of TRAIN_CHARS characters
    sample = (read.where(F.length("text") <= TRAIN_CHARS).join(F.broadcast(some), "doc_id")
              .select("doc_id", "label", "text").distinct().toPandas().sort_values(["doc_id", "label", "text"]))
    net = train(sample["text"].tolist(), sample["label"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(frames):
        import pyarrow as pa
        for got in batches(frames, ["doc_id", "text"], size=1_000_000):
            found = score_texts(shared.value, got["text"])
            yield pa.RecordBatch.from_arrays([pa.array(got["doc_id"], id_type), pa.array(found)], ["doc_id", "score"])
    from pyspark.sql.pandas.types import to_arrow_type
    kind = read.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    return read.mapInArrow(run, f"doc_id {kind.simpleString()}, score double")
