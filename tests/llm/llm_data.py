"""Small corpora for the operator tests."""

import random

EXTRA = "fp long, ht long, pos long, key string, n int, token string, spans string, recipe string, id long, kept boolean, a int, b int"
LONG = " ".join(f"w{(i * 7919) % 10007}" for i in range(12_000))
EDGES = [(1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "Plain words, five of them."), (6, LONG), (7, LONG), (8, "same " * 3000),
         (9, "x" * 50_000), (10, "ÀÉ ß 漢字 кот 12 !!"), (11, "twice over"), (11, "twice over"), (None, "a row without an id"), (None, None)]


def corpus(seed: int = 1, n: int = 120) -> list[tuple[int, str]]:
    """Documents with exact and near copies, shared passages and periodic runs."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 5)))
    texts = lambda k: " ".join(word() for _ in range(k))
    passages = [texts(rnd.randrange(14, 60)) for _ in range(4)]
    out: list[str] = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.15 and out:
            t = rnd.choice(out)
        elif kind < 0.3 and out:
            w = rnd.choice(out).split(" ")
            w[rnd.randrange(len(w))] = word()
            t = " ".join(w)
        elif kind < 0.6:
            p = rnd.choice(passages)
            t = f"{texts(rnd.randrange(0, 30))} {p}\n{texts(rnd.randrange(0, 30))} {rnd.choice(passages) if kind < 0.4 else ''}"
        elif kind < 0.7:
            t = (texts(rnd.randrange(1, 4)) + " ") * rnd.randrange(5, 60)
        else:
            t = texts(rnd.randrange(0, 150))
        out.append(t)
    ids = rnd.sample(range(1000), n)
    return list(zip(ids, out))


def frame(spark, rows, extra: bool = True, parts: int = 3):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:  # columns whose names operators might use themselves
        df = df.selectExpr("*", *[f"CAST(NULL AS {t}) AS `{c}`" for c, t in (x.split(" ") for x in EXTRA.split(", "))])
    return df.repartition(parts) if rows else df
