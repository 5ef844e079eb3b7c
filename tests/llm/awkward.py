"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows, odd columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use themselves, or that need quoting.
CLASHING = ["row", "node", "n", "kept", "x_kept", "tokens", "spans", "n_words", "place", "component", "a.b", "task", "value"]


def texts(seed, n=120, words=12):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "Zürich", "A-b", "x1"]
    out = [None, "", " \n\t", "one", "one two", "one two three", "One TWO three four", "a" * 5000 + " b c d e"]
    while len(out) < n:
        kind = r.random()
        if kind < 0.25 and len(out) > 12:
            near = (out[r.randrange(8, len(out))] or "").split(" ")
            for _ in range(r.randrange(0, 3)):
                near[r.randrange(len(near))] = r.choice(vocabulary)
            out.append(" ".join(near))
        elif kind < 0.4:
            out.append(r.choice(out))
        else:
            size = r.choice([3, 5, 8, 12, 20, 40, 90])
            seps = [" ", " ", " ", "\n", "\t", "  ", "\n\n"]
            out.append("".join(r.choice(vocabulary) + r.choice(seps) for _ in range(size)))
    return out


def rows(seed, n=120):
    r = random.Random(seed + 1)
    out = []
    for i, t in enumerate(texts(seed, n)):
        source = r.choice(["hot", "hot", "s1", "s2", None])
        out.append((i, t, r.choice(["en", None]), source, None if t is None else len(t)))
    return out


def frame(spark, data, clashing=False):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    if clashing:
        for c in CLASHING:
            df = df.withColumn(c, F.lit(c))
    # Operators that read twice need rows that stay in their parts, as files do.
    import tempfile

    path = tempfile.mkdtemp(prefix="awkward-") + "/docs"
    df.write.parquet(path)
    return spark.read.parquet(path)
