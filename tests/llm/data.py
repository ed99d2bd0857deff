"""Small documents with every hard case: nulls, empty and long texts, copies, shared passages, repeats, ties, repeated rows."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(seed: int = 5, n: int = 40) -> list[tuple]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß日") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = prose(60)
    out = []
    for i in range(n):
        out.append((i, prose(r.randint(1, 220)), r.choice(["en", "fr", None]), r.choice(["a", "b", "b", "b", None])))
    for i in range(n, n + 8):
        out.append((i, f"{prose(r.randint(0, 30))} {passage}\n{prose(r.randint(0, 30))}", "en", "a"))
    base = out[3][1] + " " + prose(120)
    for i in range(n + 8, n + 16):  # near copies
        w = base.split()
        w[r.randrange(len(w))] = "zzz"
        out.append((i, " ".join(w), "fr", "b"))
    for i in range(n + 16, n + 22):  # exact copies
        out.append((i, out[5][1], "en", "b"))
    out += [
        (100, None, "en", "a"),
        (101, "", "fr", "a"),
        (102, " \n\t ", None, None),
        (103, "one two", "en", "b"),
        (104, "one two", "en", "b"),
        (105, "ab" * 400, "en", "c"),
        (106, "x" * 900, "en", "c"),
        (107, "same " * 150, "en", "c"),
        (108, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 6, "en", "c"),
        (109, " ".join(out[7][1].split()[3:60]), "en", "c"),
        (110, prose(6000), "en", "c"),
        (None, out[9][1], "fr", "a"),
    ]
    return out + [out[11]]  # a row that is there twice


SCHEMA = "doc_id long, text string, lang string, source string"


def frame(spark, data=None):
    """The documents with columns whose names clash with those that operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    return df.withColumns({"n": F.lit(1), "d": F.lit("x"), "th": F.lit(2.0), "kept": F.lit("no"), "n_words": F.lit(0), "spans": F.lit("s"), "rank": F.lit(3)})


def key(i):
    return -1 if i is None else i
