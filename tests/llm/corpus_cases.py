"""Small documents with every awkward case, shared by the tests of the corpus operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
        # Names that the operators use inside.
        T.StructField("_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.34:
            out[i] = rng.choice("xyz")
        elif kind < 0.67:
            out.insert(i, rng.choice("xyz"))
        else:
            out.pop(i)
    return "".join(out)


def texts(seed=5):
    """(doc_id, text): copies, near copies, shared passages, repeats inside one text, blanks."""
    rng = random.Random(seed)
    passage = words(rng, 90)
    long = words(rng, 6000)
    base = [words(rng, rng.randint(30, 200)) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(20 + i, base[0]) for i in range(6)]
    out += [(30 + i, edited(rng, base[1], 2)) for i in range(6)]
    out += [(40 + i, f"{words(rng, 40)} {passage} {words(rng, 40)}") for i in range(5)]
    out += [(50, passage + "\n" + passage), (51, "é ü ñ " * 200), (52, "a" * 3000), (53, "a" * 900)]
    out += [(60, long), (61, long + " more"), (62, "\n".join(base[2:6])), (63, "\n".join(base[3:7]))]
    out += [(70, None), (71, ""), (72, "  \t\n "), (73, "one"), (74, "one two"), (75, "12 34 ?!")]
    out += [(None, base[7]), (None, None), (80, base[8]), (80, base[8]), (80, "another text of the same id")]
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t), "x", "x", "x", "x") for i, t in rows], DOCS
    ).repartition(3)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
