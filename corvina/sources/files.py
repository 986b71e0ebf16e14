"""Reading and writing beside Parquet: CSV with a mark of order, HTML links, files as rows, checkpoints by state."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV file with a header, quotes doubled inside quotes and lines inside fields; a byte order mark is skipped. Without a schema all is text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(df: DataFrame, path: str, *order: str, mode: str = "overwrite") -> None:
    """CSV with a header, null and empty both empty. With an order, rows are sorted across the files."""
    out = df.orderBy(*order) if order else df
    out.write.mode(mode).option("header", True).option("emptyValue", "").option("nullValue", "").option("escape", '"').option("lineSep", "\n").csv(path)


def csv_lines(df: DataFrame, *order: str, bom: bool = False) -> Iterable[str]:
    """The lines of a small report as one CSV text with LF ends, in order; rows stream through the driver."""
    import csv
    import io

    yield ("﻿" if bom else "") + ",".join(df.columns) + "\n"
    for r in df.orderBy(*(order or df.columns)).toLocalIterator():
        line = io.StringIO()
        csv.writer(line, lineterminator="\n").writerow(["" if v is None else v for v in r])
        yield line.getvalue()


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, href, anchor) of the links in an HTML column."""
    pattern = r'<a\s[^>]*href="([^"]*)"[^>]*>[^<]*'
    each = pages.select(key, F.explode(F.regexp_extract_all(html, F.lit(pattern), F.lit(0))).alias("a"))
    return each.select(key, F.regexp_extract("a", r'href="([^"]*)"', 1).alias("href"), F.regexp_extract("a", r">([^<]*)$", 1).alias("anchor"))


def file_rows(spark: SparkSession, path: str, *, magic: bytes | None = None, least: int = 0) -> DataFrame:
    """(path, name, modified, length, md5, valid) of the files below a path; valid ones begin with ``magic`` and have ``least`` bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    good = F.col("length") >= least
    if magic:
        good = good & (F.substring("content", 1, len(magic)) == F.lit(magic))
    return files.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("modificationTime").alias("modified"), "length", F.md5("content").alias("md5"), good.alias("valid"))


def or_else(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df``, or where it has no row the other one."""
    return other if df.isEmpty() else df


def manifest(spark: SparkSession, **tables: DataFrame) -> DataFrame:
    """(table, rows, fingerprint) of the tables, each from one scan and independent of row order."""
    from corvina.operators.quality import fingerprint

    out = None
    for name, df in tables.items():
        one = fingerprint(df, *df.columns).select(F.lit(name).alias("table"), F.col("n").alias("rows"), "fingerprint")
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "table string, rows long, fingerprint string")
    return out


def state_key(*parts: Any) -> str:
    """Twelve digits that change with any part; parts are written by repr."""
    import hashlib

    return hashlib.sha1(repr(parts).encode()).hexdigest()[:12]


def staged(spark: SparkSession, folder: str, name: str, key: str, make) -> DataFrame:
    """The table of a stage: as written before for the same state key, else made, written and read again."""
    path = f"{folder}/{name}-{key}"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def nested_json(df: DataFrame, key: str, order: Iterable[str], fields: Iterable[str], exported_at: Column) -> DataFrame:
    """One JSON text per key file: {"metadata": …, "data": {key: […]}} as rows (key, json), so no driver holds all of it."""
    from corvina.operators.analytics import keyed_json

    rows = keyed_json(df, key, list(order), list(fields))
    meta = F.to_json(F.struct(exported_at.cast("string").alias("exported_at"), F.col("total")))
    return rows.select(key, F.concat(F.lit('{"metadata":'), meta, F.lit(',"data":{'), F.to_json(F.array(F.col(key).cast("string"))).substr(F.lit(2), F.length(F.to_json(F.array(F.col(key).cast("string")))) - 2), F.lit(":"), F.col("entries"), F.lit("}}")).alias("json"))
