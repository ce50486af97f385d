"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled text train a small network by the
non-negative unbiased risk: with class prior ``p``,

    p * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p * E_pos[loss(-f)]).

No negative label is used.  The prior is estimated first: the smallest ratio of
the unlabelled to the positive share of any region ``score >= t`` of a
positive-against-unlabelled classifier (the part of the unlabelled text that
positives can explain).

Features are shares, so texts of any length compare: pairs of character
classes, repeated and distinct words per block of words, word and line lengths.
The training sample is bounded by ``SAMPLE_ROWS`` rows of each kind, the rows
of smallest id hash; its feature vectors (some 1 KB each) go to the driver,
and every text of the corpus is scored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed
from .vectors import batches, characters, is_space, runs, span_hashes

SAMPLE_ROWS = 6000
#: Class prior bounds, so that a degenerate sample still trains.
PRIOR_RANGE = (0.05, 0.98)
NOISE, DECAY = 1.0, 1e-3
N_CLASSES = 14
BLOCK_WORDS = 50
N_DENSE = 12
N_FEATURES = N_CLASSES * N_CLASSES + N_DENSE
#: Characters whose features are computed at once: the arrays have some 60 bytes a character.
FEATURE_CHARS = 250_000


def class_table() -> np.ndarray:
    """Character class of each code point up to 0xFFFF."""
    t = np.full(0x10000, 13, np.uint8)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            t[c] = (1 if ch.isupper() else 0) if c < 128 else (9 if ch.isupper() else 8 if ch.islower() else 10)
        elif ch.isdigit():
            t[c] = 2
        elif c in (32, 9, 160):
            t[c] = 3
        elif c in (10, 13):
            t[c] = 4
        elif ch == ".":
            t[c] = 5
        elif ch == ",":
            t[c] = 6
        elif ch in ";:'\"?-()":
            t[c] = 7
        elif ch == "!":
            t[c] = 11
        elif 32 < c < 127:
            t[c] = 12
    return t


def features(texts: list[str], classes: np.ndarray) -> np.ndarray:
    """One row of ``N_FEATURES`` per text; zeros for an empty one."""
    run = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) // FEATURE_CHARS
    edge = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [len(texts)])).tolist()
    # the newline after a text makes a pair with what follows it
    return np.concatenate([_features(texts[a:b], classes, (texts[b] + "\n")[0] if b < len(texts) else "") for a, b in zip(edge, edge[1:])])


def _features(texts: list[str], classes: np.ndarray, after: str) -> np.ndarray:
    n = len(texts)
    codes, start = characters(texts)
    kind = classes[np.minimum(codes, 0xFFFF)].astype(np.int32)
    doc = np.repeat(np.arange(n), np.diff(start))
    pair = np.bincount(doc[:-1] * (N_CLASSES * N_CLASSES) + kind[:-1] * N_CLASSES + kind[1:],
                       minlength=n * N_CLASSES * N_CLASSES).reshape(n, -1)
    if after:
        pair[-1, kind[-1] * N_CLASSES + classes[min(ord(after), 0xFFFF)]] += 1
    chars = np.maximum(np.diff(start) - 1, 1).astype(np.float64)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, :N_CLASSES * N_CLASSES] = pair / (chars[:, None] + 1)
    ws, we = runs(~is_space(codes))
    if len(ws):
        h = span_hashes(codes, ws, we)
        wd = doc[ws]
        words = np.bincount(wd, minlength=n).astype(np.float64)
        per = np.maximum(words, 1)
        first = np.concatenate(([0], np.cumsum(words)))[:-1].astype(np.int64)
        place = np.arange(len(ws)) - first[wd]
        same = np.concatenate(([False], (h[1:] == h[:-1]) & (wd[1:] == wd[:-1])))
        length = (we - ws).astype(np.float64)
        block = np.cumsum(np.concatenate(([0], (np.diff(wd) > 0) | (place[1:] % BLOCK_WORDS == 0))))
        order = np.lexsort((h, block))
        hb, bb = h[order], block[order]
        new = np.concatenate(([True], (hb[1:] != hb[:-1]) | (bb[1:] != bb[:-1])))
        distinct = np.bincount(bb, weights=new) / np.bincount(block)
        bdoc = wd[np.concatenate(([True], np.diff(block) > 0))]
        lowest = np.ones(n)
        np.minimum.at(lowest, bdoc, distinct)
        upper = np.add.reduceat((kind == 1) | (kind == 9), ws) >= np.maximum(we - ws - 3, 1)
        lines = np.bincount(doc[kind == 4], minlength=n).astype(np.float64)
        add = lambda v: np.bincount(wd, weights=v, minlength=n) / per
        mean = add(length)
        last = kind[we - 1]
        dense = [add(same), np.bincount(bdoc, weights=distinct, minlength=n) / np.maximum(np.bincount(bdoc, minlength=n), 1),
                 lowest, mean / 10, np.sqrt(np.maximum(add(length ** 2) - mean ** 2, 0)) / 10, add(upper),
                 add(last >= 11), add((last == 5) | (last == 6)), add(length == 1), np.minimum(lines / per, 1),
                 np.log1p(words) / 10, np.ones(n)]
        out[:, N_CLASSES * N_CLASSES:] = np.where(words[:, None] > 0, np.stack(dense, 1), 0)
    return out


def forward(net: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(((x - net["mean"]) / net["scale"]) @ net["w"] + net["b"], 0)
    return hidden, hidden @ net["v"] + net["c"]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, batch_of, steps: int, seed: int = 7, hidden: int = 16, rate: float = 0.01) -> dict:
    """Adam on the output gradient that ``batch_of(rng)`` gives with its rows.
    Noise of one standard deviation on the inputs keeps a small sample from
    being learnt by heart."""
    rng = np.random.default_rng(seed)
    net = {"mean": x.mean(0), "scale": x.std(0) + 1e-2, "w": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
           "b": np.zeros(hidden), "v": rng.normal(0, 1 / np.sqrt(hidden), hidden), "c": 0.0}
    z = (x - net["mean"]) / net["scale"]
    keys = ("w", "b", "v", "c")
    m, s = {k: 0.0 for k in keys}, {k: 0.0 for k in keys}
    for step in range(1, steps + 1):
        rows, grad_of = batch_of(rng)
        noisy = z[rows] + rng.normal(0, NOISE, (len(rows), x.shape[1]))
        h, f = forward(net, noisy * net["scale"] + net["mean"])
        g = grad_of(f)
        back = np.outer(g, net["v"]) * (h > 0)
        grads = {"w": noisy.T @ back + DECAY * net["w"], "b": back.sum(0), "v": h.T @ g + DECAY * net["v"], "c": g.sum()}
        for k in keys:
            m[k] = 0.9 * m[k] + 0.1 * grads[k]
            s[k] = 0.999 * s[k] + 0.001 * grads[k] ** 2
            net[k] = net[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def picks(rng, pos: np.ndarray, unl: np.ndarray, size: int = 256) -> np.ndarray:
    return np.concatenate([rng.choice(pos, size), rng.choice(unl, size)])


def estimate_prior(x: np.ndarray, pos: np.ndarray, unl: np.ndarray, steps: int = 300) -> float:
    """Share of the unlabelled rows that the positives can explain."""
    half = lambda v, k: v[k::2]  # noqa: E731  fitted on one half, measured on the other

    def plain(rng):
        rows = picks(rng, half(pos, 0), half(unl, 0))
        y = np.repeat([1.0, 0.0], len(rows) // 2)
        return rows, lambda f: (sigmoid(f) - y) / len(rows)
    net = fit(x, plain, steps)
    p, u = np.sort(forward(net, x[half(pos, 1)])[1]), np.sort(forward(net, x[half(unl, 1)])[1])
    cuts = np.quantile(p, np.linspace(0.01, 0.7, 70))  # regions that hold at least 30 % of the positives
    share = lambda v: 1 - np.searchsorted(v, cuts) / len(v)
    return float(np.clip((share(u) / share(p)).min(), *PRIOR_RANGE))


def train(x: np.ndarray, positive: np.ndarray, steps: int = 600) -> dict:
    """The network fitted by the non-negative risk; ``positive`` marks the
    trusted rows, all others are unlabelled."""
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    if len(pos) < 2 or len(unl) < 2:  # nothing to learn from: every score is 0.5 or, with positives only, above it
        net = fit(np.zeros((2, x.shape[1] if x.ndim == 2 else N_FEATURES)), lambda r: (np.arange(1), lambda f: f * 0), 1)
        return net | {"v": net["v"] * 0, "c": 1.0 if len(pos) else 0.0, "prior": float("nan")}
    prior = estimate_prior(x, pos, unl)

    def risk(rng):
        rows = picks(rng, pos, unl)
        n = len(rows) // 2

        def grad(f):
            # sigmoid loss: loss(f) = sigmoid(-f), with derivative -s(1 - s)
            s = sigmoid(f)
            slope = s * (1 - s) / n
            fp, fu = slope[:n], slope[n:]
            negative = s[n:].mean() - prior * s[:n].mean()
            if negative >= 0:
                return np.concatenate([-2 * prior * fp, fu])
            return np.concatenate([prior * fp, -fu])  # go back up to 0 risk on negatives
        return rows, grad
    return fit(x, risk, steps) | {"prior": prior}


def sample_features(docs: DataFrame, flags: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of at most ``rows`` positives and ``rows`` other documents."""
    classes = class_table()
    by = F.xxhash64("doc_id", F.lit(10))
    ids = flags.where("doc_id IS NOT NULL").select("doc_id", "positive", by.alias("at"))
    some = (ids.where("positive").orderBy("at", "doc_id").limit(rows)
            .unionByName(ids.where("NOT positive").orderBy("at", "doc_id").limit(rows)))

    def run(frames):
        import pyarrow as pa
        for got in batches(frames, ["positive", "text"]):
            x = features(got["text"], classes)
            yield pa.RecordBatch.from_arrays([pa.array(got["positive"]), pa.array([r.tobytes() for r in x])], ["positive", "x"])
    # at most 2 * rows ids: broadcast by its bound
    out = (docs.join(F.broadcast(some.select("doc_id", "positive")), "doc_id").select("positive", "text")
           .mapInArrow(run, "positive boolean, x binary").toPandas())
    if not len(out):
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0, bool)
    # in an order of the rows themselves, as tasks may end in any
    out = out.sort_values(["positive", "x"], kind="stable")
    return (np.stack([np.frombuffer(b, np.float32) for b in out["x"]]), out["positive"].to_numpy(bool))


def score(docs: DataFrame, positives: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS, rows: bool = False) -> DataFrame:
    """Every row of ``docs`` as ``doc_id`` and ``score`` (0 to 1; at 0.5 and
    above the text is of the positive class).  ``positives`` has the ids of
    trusted positives; all other documents are unlabelled.

    Null and empty texts have a score too (that of all-zero features).  A
    repeated row is scored each time; a null id is scored and never trains.
    Without positives every score is 0.5; without other documents it is above.  Empty
    tables: no rows.  Other columns are not read.  With ``rows``, the column ``row`` of ``keyed``
    goes with ``doc_id``.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id"]
    if rows:
        read, names = keyed(read), ["doc_id", "row"]
    trusted = positives.select(F.col(positives.columns[0]).alias("doc_id")).distinct().withColumn("positive", F.lit(True))
    flags = (read.select("doc_id").distinct().join(trusted, "doc_id", "left")
             .select("doc_id", F.coalesce("positive", F.lit(False)).alias("positive")))
    x, positive = sample_features(read, flags, sample_rows)
    net = train(x.astype(np.float64), positive)
    classes = class_table()

    def run(frames):
        import pyarrow as pa
        for got in batches(frames, [*names, "text"]):
            f = forward(net, features(got["text"], classes))[1]
            yield pa.RecordBatch.from_arrays([*(pa.array(got[c], t) for c, t in zip(names, (id_type, pa.int64()))), pa.array(sigmoid(f))],
                                             [*names, "score"])
    from pyspark.sql.pandas.types import to_arrow_type
    kind = read.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    return read.mapInArrow(run, f"doc_id {kind.simpleString()}, {'row long, ' if rows else ''}score double")
