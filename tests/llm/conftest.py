import random

import pytest
from pyspark.sql import functions as F

# Names that the operators use inside, as further columns of a table.
CLASHING = ["_id", "hash", "_hash", "node", "size", "kind", "line", "line_no", "c0", "c1", "_text", "words", "n", "key", "_key", "_kept", "root", "taken", "start", "item", "cuts"]


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, source) rows, with clashing further columns."""

    def build(rows, clashing=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)]) if clashing else df

    return build


@pytest.fixture
def prose():
    """Different, harmless sentences of invented words."""
    rng = random.Random(7)
    syllables = "ba co di fu ge ha ki lo mu ne po ra si tu ve wo xa yi zu le".split()

    def build(words, seed=None):
        own = random.Random(seed) if seed is not None else rng
        made = ["".join(own.choice(syllables) for _ in range(own.randint(2, 4))) for _ in range(words)]
        return " ".join(w + "." if i % 12 == 11 else w for i, w in enumerate(made))

    return build
