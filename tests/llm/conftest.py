import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns that operators use inside or return; they must not disturb anything.
CLASHING = ["_block", "_row", "score", "fingerprint", "start", "key", "a", "_c0", "a.b", "lang2"]


def sample_rows() -> list[tuple]:
    """Plain, empty, blank, null, repeated, copied, very long and non-Latin texts, with repeated and null ids."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["The", "naïve", "Straße", "ὈΔΟΣ", "日本", "x.", "a,b", "🙂"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = say(50)
    rows = [(i, say(rng.randint(1, 90))) for i in range(40)]
    rows += [(40 + i, f"{say(20)} {passage}\n{say(rng.randint(0, 40))}") for i in range(12)]
    rows += [(60, None), (61, ""), (62, " \t\n "), (63, "one"), (64, "one two"), (None, say(30)), (None, None)]
    copy = say(70)
    rows += [(70 + i, copy) for i in range(9)] + [(80, copy + " more"), (81, copy.upper())]
    rows += [(90, rows[3][1]), (90, rows[3][1]), (3, rows[3][1]), (91, say(30) + " " + "y" * 70_000 + " " + say(6000)), (92, passage + " " + passage)]
    return [(i, t, None if n % 5 == 0 else "en", "s" if n % 3 else None, None if t is None else len(t)) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
