"""Small documents with every odd case, shared by the operator tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts() -> list:
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma,", "Delta.", "straße", "éclair", "naïve", "東京", "x1", "it's", "👍", "don't!"]
    long = " ".join(rng.choice(words) for _ in range(6000))
    base = " ".join(rng.choice(words) for _ in range(120))
    return [None, "", " \t\n ", "one", "one two", "ONE two", "a\u00a0b", base, base, base + " tail", base.upper(),
            long, long + " end", "tab\tand\x0bvt", "ß ǅ İ Σας ﬁ", "e\u0301 combining", "<|endoftext|> special"]


def odd_docs(spark, extra: bool = True):
    """Nulls in every column, repeated rows, null ids, and columns whose
    names operators might use themselves."""
    rows = [(i, t, "en" if i % 3 else None, ["src0", "src1", None][i % 3], None if t is None else len(t))
            for i, t in enumerate(odd_texts())]
    rows += [rows[7], rows[3], (None, "no id", None, "src0", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("size", "fp", "length", "rank", "part", "u", "v", "cluster", "node", "word", "key", "score", "spans"):
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit("clash"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
