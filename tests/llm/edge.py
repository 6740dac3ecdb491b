"""A small table with nulls, empty and long texts, ties, repeated rows and columns of clashing names."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, cls long, hit string, "
          "kept boolean, original string, n_words string")


def rows():
    rng = random.Random(4)
    vocab = ["alpha", "beta", "gamma", "delta", "Epsilon", "zeta,", "eta.", "theta", "iota", "é", "ñu"] + [f"w{i}" for i in range(90)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = say(60)
    texts = [say(rng.choice([1, 4, 5, 30, 120])) for _ in range(24)]
    texts += [f"{say(20)}\n{passage}\n{say(8)}" for _ in range(4)]
    base = say(150).split()
    for i in range(4):
        copy = list(base)
        copy[30 * i] = "changed"
        texts.append(" ".join(copy))
    texts += ["", None, " \n\t ", "x" * 5000, say(6000), "same text " * 40, "same text " * 40, "a\x00b \x1c c  d\r\nnbsp x"]
    out = [(i, t, ["en", "de", None][i % 3], "src0", len(t or ""), 0.5, 7, "h", None, "o", "n") for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, "no id here", None, None, None, None, None, None, None, None, None),
                  (None, None, None, None, None, None, None, None, None, None, None)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def labels(spark):
    return spark.createDataFrame([(i, i % 5 != 0, i % 7 == 0) for i in range(30)] + [(None, True, None), (3, None, None)],
                                 "doc_id long, quality boolean, toxic boolean").selectExpr(
        "doc_id", "cast(quality as int) quality", "cast(toxic as int) toxic")
