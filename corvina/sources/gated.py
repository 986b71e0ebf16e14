"""Tables published by a pointer, after checks that the write itself has counted.

A version is written to a folder of its own. Its figures come from the same scan (``observe``); only where all of
them hold does the pointer move, so readers see the last good version, whole, at any time.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

POINTER = "_current.json"


class Rejected(ValueError):
    """A version whose figures don't hold; it stays where it was written, unpublished."""

    def __init__(self, failed: list[str], figures: Mapping[str, Any], path: str):
        super().__init__(f"{', '.join(failed)} of {path}: {dict(figures)}")
        self.failed, self.figures, self.path = failed, dict(figures), path


def _store(path: str) -> tuple[Any, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _point(folder: str, value: dict[str, Any]) -> None:
    store, inner = _store(folder)
    fresh = f"{inner}/.{uuid.uuid4().hex}.json"
    store.create_dir(inner, recursive=True)
    with store.open_output_stream(fresh) as f:
        f.write(json.dumps(value, default=str).encode())
    store.move(fresh, f"{inner}/{POINTER}")


def pointer(folder: str) -> dict[str, Any] | None:
    """The published version, its path and figures; None before the first."""
    store, inner = _store(folder)
    from pyarrow.fs import FileType

    if store.get_file_info(f"{inner}/{POINTER}").type != FileType.File:
        return None
    with store.open_input_stream(f"{inner}/{POINTER}") as f:
        return json.loads(f.read())


def publish(df: DataFrame, folder: str, checks: Mapping[str, tuple[Column, Callable[[Any], bool]]], *, key: str | None = None) -> dict[str, Any]:
    """Write ``df`` as a version under ``folder`` and point to it if all ``checks`` hold; returns its figures.

    A check is an aggregate over the rows and whether its value will do: counts of violations, sums, smallest and largest
    values. They are counted while the rows are written. A failed check raises ``Rejected`` and leaves the pointer alone.
    """
    version = uuid.uuid4().hex
    path, seen = f"{folder}/{version}", Observation(f"publish-{version}")
    observed = df.observe(seen, *[c.alias(n) for n, (c, _) in checks.items()]) if checks else df
    observed.write.parquet(path)
    figures = seen.get if checks else {}
    failed = [n for n, (_, holds) in checks.items() if not holds(figures.get(n))]
    if failed:
        raise Rejected(failed, figures, path)
    _point(folder, {"path": path, "key": key, "figures": figures})
    return figures


def published(spark: SparkSession, folder: str) -> DataFrame | None:
    """The published version, None before the first."""
    at = pointer(folder)
    return None if at is None else spark.read.parquet(at["path"])


def state_of(df: DataFrame) -> str:
    """A digest of what ``df`` computes and of the size and time of every file that it reads: equal while neither changes."""
    states = []
    for path in sorted(df.inputFiles()):
        store, inner = _store(path)
        info = store.get_file_info(inner)
        states.append((path, info.size, info.mtime_ns))
    return hashlib.sha256(repr((df.semanticHash(), df.schema.simpleString(), states)).encode()).hexdigest()


def stage(df: DataFrame, folder: str, checks: Mapping[str, tuple[Column, Callable[[Any], bool]]] | None = None) -> DataFrame:
    """``df`` as published before, where its plan and files are the same; else computed, checked and published now."""
    key = state_of(df)
    at = pointer(folder)
    if at is None or at.get("key") != key:
        publish(df, folder, checks or {}, key=key)
        at = pointer(folder)
    return df.sparkSession.read.parquet(at["path"])
