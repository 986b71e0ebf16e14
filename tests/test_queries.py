"""Every query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from corvina.plans import load
from corvina.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

load()


def rows(frame, columns):
    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v) or type(v).__name__ in ("NAType", "NaTType"):
            return None
        if hasattr(v, "item"):
            v = v.item()
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert name in ORACLES
    got, want = QUERIES[name](spark, SF).toPandas(), db.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(want, columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_llm():
    root = Path(__file__).parents[1] / "corvina"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "corvina.llm" not in p.read_text(), p
