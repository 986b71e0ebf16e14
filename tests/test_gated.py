"""Publishing by a pointer, checks from the write's own scan, stages by plan and files, errors of downloads."""

import pytest
from pyspark.sql import functions as F

from corvina.sources import gated, web

def checks():
    return {"rows": (F.count(F.lit(1)), lambda n: n > 0), "bad": (F.count_if(F.col("v") < 0), lambda n: n == 0), "top": (F.max("v"), lambda v: v is None or v < 100)}



def counted(spark, rows):
    """Rows that count how often they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return spark.createDataFrame([(v,) for v in rows], "v long").mapInPandas(run, "v long"), seen


def test_checks_need_no_second_scan(spark, tmp_path):
    df, seen = counted(spark, range(50))
    figures = gated.publish(df, str(tmp_path / "t"), checks())
    assert figures == {"rows": 50, "bad": 0, "top": 49} and seen.value == 50
    assert gated.published(spark, str(tmp_path / "t")).count() == 50 and gated.pointer(str(tmp_path / "t"))["figures"]["rows"] == 50


def test_a_bad_version_is_kept_back(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert gated.published(spark, folder) is None
    gated.publish(spark.range(3).selectExpr("id AS v"), folder, checks())
    for rows, failed in (([-1, 5], ["bad"]), ([], ["rows"]), ([-1, 500], ["bad", "top"])):
        with pytest.raises(gated.Rejected) as e:
            gated.publish(spark.createDataFrame([(v,) for v in rows], "v long"), folder, checks())
        assert e.value.failed == failed and gated.published(spark, folder).count() == 3
    gated.publish(spark.range(7).selectExpr("id AS v"), f"file://{folder}", checks())
    assert gated.published(spark, folder).count() == 7


def test_stages_by_plan_and_files(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stage")
    spark.range(5).write.parquet(source)
    plan = lambda most=10: spark.read.parquet(source).where(F.col("id") < most).selectExpr("id AS v")
    first = gated.stage(plan(), folder, checks())
    at = gated.pointer(folder)["path"]
    assert first.count() == 5 and gated.stage(plan(), folder, checks()).count() == 5 and gated.pointer(folder)["path"] == at
    assert gated.stage(plan(3), folder).count() == 3 and gated.pointer(folder)["path"] != at
    spark.range(5, 8).write.mode("append").parquet(source)
    assert gated.stage(plan(), folder).count() == 8


def test_errors_of_downloads(spark):
    documents = spark.createDataFrame([("A", "directive", "u1"), ("B", "directive", "u1"), ("A", "delivery", "u2"), ("C", "delivery", "u3"), ("D", "delivery", None), ("E", "delivery", "u9")], "owner string, document string, url string")
    pages = {"u1": (200, b"%PDF" + b"x" * 20_000), "u2": (200, b"<html>"), "u3": (500, b"")}
    landed = web.download(documents.where("url <> 'u9'"), get=lambda u, t: pages[u], delay=0.0)
    out, errors = web.with_files(documents, landed)
    assert {(r["owner"], r["document"]): r["status"] for r in out.collect()} == {("A", "directive"): "ok", ("B", "directive"): "ok", ("A", "delivery"): "not_the_type", ("C", "delivery"): "failed", ("D", "delivery"): "absent", ("E", "delivery"): "missing"}
    assert sorted((r["owner"], r["kind"]) for r in errors.collect()) == [("A", "not_the_type"), ("C", "failed"), ("E", "missing")]
