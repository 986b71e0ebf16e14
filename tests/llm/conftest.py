import duckdb
import pytest


@pytest.fixture(scope="session")
def texts():
    """Awkward documents: nulls, empty and long texts, repeated rows and ids, copies and near copies."""
    base = " ".join(f"word{i}" for i in range(200))
    near = base.replace("word7 ", "seven ")
    long_ = " ".join(f"t{i % 997}" for i in range(20_000))
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "en", "b", 1), (4, None, "en", "a", 0), (5, "", None, "b", 0), (6, "   \n ", "en", None, 3),
        (7, "one", "en", "a", 3), (7, "one", "en", "a", 3), (8, "Ünïcode wörds İ ß é", "de", "a", 9), (9, long_, "en", "c", len(long_)), (None, "no id here at all", "en", "c", 5), (10, "other text entirely", "en", "c", 5),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def db():
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c
