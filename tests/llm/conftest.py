import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, copies, near copies and repeated rows."""
    base = words(1, 300)
    rows = [
        (0, base, "en", "a", 1),
        (1, base, "en", "a", None),
        (1, base, "en", "a", None),
        (2, base.replace("a", "b", 2), None, None, 3),
        (3, "", "de", "b", 0),
        (4, None, "de", "b", None),
        (None, words(2, 80), "fr", "c", 5),
        (None, None, None, None, None),
        (5, " \n\t ", "fr", "c", 4),
        (6, words(3, 40_000), "es", "d", 1),
        (7, "Ünïcødé 日本 😀 ▁x\0y\x1c z", "es", "d", 9),
        (8, "one two three", "es", "d", 9),
        (9, "junk### " * 200, "en", "e", 9),
        (-5, words(4, 120) + "\n" + words(4, 120), "en", "e", 9),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Columns with names that operators use themselves."""
    from pyspark.sql import functions as F

    for c in ("score", "kept", "fp", "d", "h", "ids", "key", "uid", "n", "at", "label", "spans", "_v", "_d", "_h", "_spans", "passages", "_verdict", "_score", "row", "x", "y", "t", "place", "media", "word", "fingerprint", "component_id"):
        docs = docs.withColumn(c, F.lit("x"))
    return docs


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 3 != 0), 0) for i in range(-5, 200)] + [(None, 1, 0), (7, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def graded(spark):
    """Documents and labels in which label 0 is junk."""
    rows, marks = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = words(1000 + i, 90)
        if bad:
            text = " ".join(w + "###" if k % 2 else w.upper() + "!!" for k, w in enumerate(text.split()))
        rows.append((i, text, "en", "s", len(text)))
        marks.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
