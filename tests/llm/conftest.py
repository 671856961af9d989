import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASH = ("row", "size", "key", "stats", "state", "bucket", "position", "shard", "slot", "words", "kept", "copies", "base", "spans", "gain", "_words", "hits", "end", "a", "b")


def words(n, start=0, alphabet="abcdefghij"):
    return " ".join("".join(alphabet[int(c)] for c in str(start + k)) for k in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies."""
    long = words(40_000, 10_000)
    near = words(300, 500)
    rows = [
        (1, words(30), "en", "s1"), (1, words(30), "en", "s1"), (2, "", "en", "s1"), (3, None, "de", "s2"), (4, long, "en", "s2"), (5, long + " tail", "en", "s2"),
        (6, near, "en", None), (7, near.replace("fjj", "zzz"), "en", None), (8, near, None, "s3"), (None, words(25, 90), "en", "s1"), (None, None, None, None), (10, " \n\t ", "fr", "s3"),
        (11, "x " * 500, "en", "s1"), (12, "Ünïcödé 😀 " * 20, "de", "s2"), (13, "a@b.co 1.2.3.4 +1 (555) 555-1234 4111 1111 1111 1111", "en", "s1"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def wide(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, words(12, 3)), (2, "short item"), (3, None), (None, words(10, 505)), (4, "")], "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (4, None, None), (6, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(sample):
    return {r["doc_id"]: r["text"] for r in sample.collect()}
