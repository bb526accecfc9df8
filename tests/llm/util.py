"""Small documents that hold the awkward cases."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(spark):
    """Null columns, empty and long texts, copies, near copies, ties and repeated rows."""
    rng = random.Random(7)
    rows = []
    base = words(rng, 120)
    for i in range(30):
        rows.append((i, words(rng, rng.choice([1, 2, 3, 8, 60, 150])), "en", f"s{i % 4}", None))
    for i in range(30, 36):
        rows.append((i, base, "en", "s0", 5))
    for i in range(36, 46):
        changed = base.split()
        changed[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(changed), "en", "s1", 5))
    rows += [
        (50, None, None, None, None),
        (51, "", "en", None, 0),
        (52, "   \n\t ", "en", "s2", 6),
        (53, "A b C", "en", "s2", 5),
        (54, "a B c", "en", "s2", 5),
        (55, words(rng, 30_000, 3000), "en", "s3", 1),
        (None, base, "en", "s1", 1),
        (None, "only here", "en", "s1", 1),
        (60, "same row twice " * 40, "en", "s1", 1),
        (60, "same row twice " * 40, "en", "s1", 1),
        (61, "é漢字😀 ▁mark ▁▁ <|endoftext|> x<|endoftext|>  y", "fr", "s2", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def with_clashes(docs):
    """The same documents with columns that the operators use inside."""
    from pyspark.sql import functions as F

    names = ["row", "sha", "kept", "key", "size", "copies", "block", "part", "n", "h", "target", "hit", "word", "body"]
    return docs.select("*", *(F.lit(1).alias(n) for n in names))
