"""Small tables with the awkward rows every operator must handle."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators might use themselves.
CLASH = {"key": "int", "h": "string", "size": "string", "shard": "string", "digest": "int", "spans": "int", "stratum": "int", "n": "int", "label": "string"}


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(rng: random.Random) -> list[tuple]:
    """Null and empty texts, one word, white space, very long, copies, repeated rows, odd characters."""
    base = words(rng, 300)
    texts = [None, "", " \n\t ", "word", base, base, base + " tail", "ÄÖ é x y 日本語 \U0001f600 " + words(rng, 30), words(rng, 30_000), "a" * 5000, "x\x00y " * 300]
    texts += [words(rng, rng.randrange(5, 400)) for _ in range(20)]
    rows = [(i, t, rng.choice(["en", "de", None]), "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, "no id " + words(rng, 50), None, None, 1), (None, None, None, None, None)]


def docs_frame(spark, rows, clash: bool = False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({c: F.lit("7").cast(t) for c, t in CLASH.items()}) if clash else df
