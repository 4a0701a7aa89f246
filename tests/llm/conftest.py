import random

import pytest

#: Columns beside the operators' own whose names clash with inputs (by case) and with internal names.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, doc long, h int, __0 string, spans string"


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Small corpus: nulls, blanks, ties, copies, near copies, repeated rows, a long text."""
    rng = random.Random(5)
    base = words(rng, 120)
    line = "this line is shared by many documents of the corpus"
    rows = [(i, words(rng, 60) + "\n" + line + "\n" + words(rng, 30)) for i in range(1, 13)]
    rows += [(20 + i, base) for i in range(6)]
    rows += [(30 + i, base.replace(base.split()[5 * i], "changed", 1)) for i in range(6)]
    rows += [(50, None), (51, ""), (52, " \t\n\x0b\x0c\r "), (53, "one"), (54, "Two Words"), (55, "two words"), (None, line + "\n" + line), (56, "é😀 ñ\x85x\xa0y " + line.upper())]
    rows += [(60, words(rng, 30_000)), (61, "x" * 100_000), (12, rows[11][1])]
    langs, sources = ["en", "de", None, "xx"], ["b", "a", None]
    return [(i, t, langs[n % 4], sources[n % 3], len(t) if t else None, "other", n, n, "zero", "s") for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
