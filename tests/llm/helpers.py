"""Fixtures and brute-force versions for the training-data operators."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC)


def rng(seed=7):
    return random.Random(seed)
