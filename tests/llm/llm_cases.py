"""Texts and rows that every operator must take: nulls, empty and long texts, ties,
repeated rows, extra columns whose names clash."""

import random

from pyspark.sql import functions as F

CLASHES = ["text_hash", "size", "runs", "words", "n", "f", "key", "phrase", "label2", "row", "kept", "links", "part", "best", "collapsed", "id", "t"]


def prose(rnd, n, letters="abcdefghij"):
    return " ".join("".join(rnd.choices(letters, k=rnd.randint(1, 3))) for _ in range(n))


def documents(spark, texts, langs=("en", "de", None), ids=None):
    """Documents with clashing extra columns, over three partitions; the last row once more, and one of nulls."""
    ids = ids or range(len(texts))
    rows = [(i, t, langs[k % len(langs)]) for k, (i, t) in enumerate(zip(ids, texts))]
    rows += [rows[-1], (None, texts[-1], "en"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(3)


def rnd(seed):
    return random.Random(seed)
