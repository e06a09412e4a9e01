"""Small tables for the operators' tests."""

import random

WORDS = [a + b + c for a in ("ba", "ko", "ti", "mu") for b in ("ra", "len", "so") for c in ("n", "st", "", "vi")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def docs(spark, rows):
    """(doc_id, text[, lang, source]) with the columns of documents and one that clashes with names used inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None, "x") for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, tid string")
