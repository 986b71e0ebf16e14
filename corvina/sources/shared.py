"""Results kept in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a kept table that a join may broadcast; a larger one is joined by exchange.
BROADCAST_ROWS = 100_000
#: Bytes of such a table, written as text, that a join may broadcast.
BROADCAST_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, by its own setting ``spark.checkpoint.dir``; a local session without one gets a temporary folder, any other is refused."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir names no folder that the executors share")
            where = tempfile.mkdtemp(prefix="corvina-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder; what reads it, however often, starts from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def near(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A kept table marked for broadcast if it has no more than ``most`` rows; else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def sized(df: DataFrame, most: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A kept table marked for broadcast where its rows and bytes are few, else for a join by exchange.

    Either way the other side is never broadcast. Spark estimates it by the size of its files, which says nothing of rows that
    arrays are unpacked to.
    """
    rows, held = df.agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(df) if rows <= most and (held or 0) <= size else df.hint("merge")
