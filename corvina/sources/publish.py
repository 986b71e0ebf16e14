"""Small driver-side outputs: constants, reports, bundles and staleness checks.

All of it works on results that are reports already; the engine's tables are written by Spark.
"""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

#: The largest report that is turned into text on the driver.
REPORT_ROWS = 100_000


def rows_of(df: DataFrame, *order: str, most: int = REPORT_ROWS) -> list[dict[str, Any]]:
    """The rows of a report in order; one with more than ``most`` rows is refused."""
    out = []
    for r in df.orderBy(*(order or df.columns)).toLocalIterator():
        if len(out) == most:
            raise ValueError(f"a report has more than {most} rows")
        out.append(r.asDict(recursive=True))
    return out


def script_constants(values: Mapping[str, Any]) -> str:
    """A script that defines each value as a constant."""
    return "".join(f"const {k} = {json.dumps(v, ensure_ascii=False, default=str)};\n" for k, v in values.items())


def markdown_table(rows: Iterable[Mapping[str, Any]], columns: Iterable[str]) -> str:
    """A Markdown table."""
    columns = list(columns)
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines += ["| " + " | ".join("" if r.get(c) is None else str(r[c]).replace("|", "\\|") for c in columns) + " |" for r in rows]
    return "\n".join(lines) + "\n"


def between_marks(page: str, name: str, content: str) -> str:
    """``page`` with the content between its two marks, which are added before </head> where missing; repeating it changes nothing."""
    a, b = f"<!-- {name}:start -->", f"<!-- {name}:end -->"
    block = f"{a}\n{content}\n{b}"
    if a in page and b in page:
        return page[: page.index(a)] + block + page[page.index(b) + len(b) :]
    at = page.find("</head>")
    return page[:at] + block + "\n" + page[at:] if at >= 0 else block + "\n" + page


def file_facts(path: str | Path) -> dict[str, Any]:
    """Bytes, lines and SHA-256 of a file, read in pieces."""
    h, size, lines = hashlib.sha256(), 0, 0
    with open(path, "rb") as f:
        while piece := f.read(1 << 16):
            h.update(piece)
            size += len(piece)
            lines += piece.count(b"\n")
    return {"bytes": size, "lines": lines, "sha256": h.hexdigest()}


def bundle(files: Mapping[str, bytes], *, required: Iterable[str] = (), date: tuple[int, int, int] = (1980, 1, 1)) -> bytes:
    """A zip archive whose bytes depend on the files and the date alone; missing required files raise."""
    if missing := sorted(set(required) - set(files)):
        raise FileNotFoundError(", ".join(missing))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(files):
            info = zipfile.ZipInfo(name, (*date, 0, 0, 0))
            info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o644 << 16
            z.writestr(info, files[name])
    return out.getvalue()


def stale(made: Mapping[str, str | bytes], folder: str | Path) -> list[str]:
    """Names of files that are missing or differ from what would be made now."""
    out = []
    for name, content in made.items():
        p = Path(folder, name)
        raw = content.encode() if isinstance(content, str) else content
        if not p.exists() or p.read_bytes() != raw:
            out.append(name)
    return sorted(out)
