"""Fetching from the web: each distinct address once, in Python tasks.

Requests wait, retry after 503 and failures with growing pauses, and give a row with an error
instead of stopping the scan. The fetcher is a parameter, so tests need no network.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETRIES, DELAY, TIMEOUT = 4, 2.0, 90.0


def fetch(url: str, *, retries: int = RETRIES, delay: float = DELAY, timeout: float = TIMEOUT, get: Callable[[str, float], tuple[int, bytes]] | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes | None:
    """The body at the address, None once all attempts failed; pauses double from attempt to attempt."""

    def plain(u: str, t: float) -> tuple[int, bytes]:
        with urllib.request.urlopen(u, timeout=t) as r:
            return r.status, r.read()

    get = get or plain
    for attempt in range(1, retries + 1):
        sleep(delay)
        try:
            status, body = get(url, timeout)
            if status == 200:
                return body
        except (OSError, urllib.error.URLError):
            pass
        if attempt < retries:
            sleep(delay * 2**attempt)
    return None


@dataclass(frozen=True)
class Landing:
    """What a downloaded file must be."""

    magic: bytes = b"%PDF"
    least: int = 1000
    small: int = 10_000


def download(urls: DataFrame, url: str = "url", *, rule: Landing = Landing(), get: Callable[[str, float], tuple[int, bytes]] | None = None, delay: float = DELAY) -> DataFrame:
    """(url, content, status) for each distinct address: ok, small, not_the_type or failed; each is fetched once."""
    from pyspark.sql import types as T

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = []
            for u in batch[url]:
                body = fetch(u, get=get, delay=delay)
                status = "failed" if body is None else "not_the_type" if not body.startswith(rule.magic) or len(body) < rule.least else "small" if len(body) < rule.small else "ok"
                rows.append((u, body, status))
            yield pd.DataFrame(rows, columns=["url", "content", "status"])

    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("content", T.BinaryType()), T.StructField("status", T.StringType())])
    return urls.where(F.col(url).isNotNull()).select(url).distinct().mapInPandas(run, schema)


def with_files(documents: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with the status of their address, errors) of documents (owner, document, url) and what ``download`` gave.

    Documents that share an address share its file. errors has one row (owner, document, stage, kind, message) for each document
    whose address failed, is no file of the type, is small, or is missing from ``landed``; a document without an address has
    status absent and no error.
    """
    known = landed.select(F.col("url").alias("__u"), F.col("status").alias("__s"))
    out = documents.join(known, F.col("url") == F.col("__u"), "left").withColumn("status", F.when(F.col("url").isNull(), "absent").otherwise(F.coalesce("__s", F.lit("missing")))).drop("__u", "__s")
    wrong = out.where(~F.col("status").isin("ok", "absent"))
    return out, wrong.select("owner", "document", F.lit("download").alias("stage"), F.col("status").alias("kind"), F.concat(F.lit("download of "), "url", F.lit(": "), "status").alias("message"))
