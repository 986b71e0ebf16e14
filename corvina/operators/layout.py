"""Lines, columns and tables from positioned pieces of text, by clustering gaps with windows over a page.

Runs are rows (doc, page, x, y, width, size, text), y upwards. Everything is decided within a page, so a
collection of any size is as many small groups as it has pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.text import squeeze

#: In sizes of the text: steps down that begin a new line, gaps that part words and columns, and gaps between lines that end a table.
LINE_STEP, WORD_GAP, COLUMN_GAP, TABLE_GAP = 0.5, 0.15, 1.2, 3.0
PAGE = ("doc", "page")


def _steps(df: DataFrame, by, starts: Column, name: str) -> DataFrame:
    """``df`` numbered by how often something has started up to each row."""
    return df.withColumn("__s", starts).withColumn(name, F.count_if("__s").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("__s")


def placed_runs(runs: DataFrame) -> DataFrame:
    """``runs`` with line, from 1 on each page by steps down, and cell, from 1 in each line by gaps of a column's width.

    Runs without text, place or size, such as those of pages that couldn't be read, are left out; a null width is 0.
    """
    r = runs.where(F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("size") > 0) & (squeeze(F.coalesce("text", F.lit(""))) != ""))
    r = r.select(*PAGE, "x", "y", F.coalesce("width", F.lit(0.0)).alias("width"), "size", "text")
    down = Window.partitionBy(*PAGE).orderBy(F.desc("y"), "x", "text")
    last = F.lag("y").over(down)
    r = _steps(r, down, last.isNull() | (last - F.col("y") > LINE_STEP * F.col("size")), "line")
    along = Window.partitionBy(*PAGE, "line").orderBy("x", F.desc("y"), "text")
    end = F.max(F.col("x") + F.col("width")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("gap", F.col("x") - end)
    r = _steps(r, along, F.col("gap").isNull() | (F.col("gap") > COLUMN_GAP * F.col("size")), "cell")
    return r.withColumn("piece", F.struct("x", (-F.col("y")).alias("up"), "text", F.coalesce(F.col("gap") > WORD_GAP * F.col("size"), F.lit(False)).alias("apart")))


def _joined(pieces: Column) -> Column:
    """The pieces' texts from left to right, a blank where they stand apart."""
    return squeeze(F.array_join(F.transform(F.array_sort(pieces), lambda p: F.concat(F.when(p["apart"], " ").otherwise(""), p["text"])), ""))


def cells(runs: DataFrame) -> DataFrame:
    """(doc, page, line, cell, x0, x1, y, size, text): the parts of each line that gaps keep apart."""
    return placed_runs(runs).groupBy(*PAGE, "line", "cell").agg(F.min("x").alias("x0"), F.max(F.col("x") + F.col("width")).alias("x1"), F.max("y").alias("y"), F.max("size").alias("size"), _joined(F.collect_list("piece")).alias("text"))


def lines(runs: DataFrame) -> DataFrame:
    """(doc, page, line, text): the lines of each page from the top, their cells parted by a blank."""
    one = cells(runs).groupBy(*PAGE, "line").agg(F.array_sort(F.collect_list(F.struct("cell", "text"))).alias("c"))
    return one.select(*PAGE, "line", F.array_join(F.transform("c", lambda x: x["text"]), " ").alias("text"))


def tables(runs: DataFrame, *, columns: int = 3) -> DataFrame:
    """(doc, page, tbl, header, rows) of every table: ``columns`` columns at least, a header and one row.

    A table is a run of lines, each with two cells or more or wholly within the columns of those, that no gap of TABLE_GAP sizes
    parts. Cells whose extents overlap anywhere in it share a column. A line that lacks the first column goes on with the row
    above it unless it stands as far from it as the table's rows stand from each other: its texts are put behind theirs. Empty cells are "".
    """
    c = cells(runs).withColumn("n", F.count("*").over(Window.partitionBy(*PAGE, "line")))
    ends = Window.partitionBy(*PAGE).orderBy("line")
    one = c.groupBy(*PAGE, "line").agg(F.max("y").alias("y"), F.max("size").alias("size"), F.max("n").alias("n"), F.min("x0").alias("low"), F.max("x1").alias("high"))
    # A line of one cell belongs to a table only between lines of several.
    one = one.withColumn("above", F.lag("y").over(ends) - F.col("y")).withColumn("parted", F.col("above").isNull() | (F.col("above") > TABLE_GAP * F.col("size")))
    one = _steps(one, ends, F.col("parted"), "block")
    block = Window.partitionBy(*PAGE, "block")
    wide = F.when(F.col("n") >= 2, F.col("line"))
    one = one.withColumn("first", F.min(wide).over(block)).withColumn("last", F.max(wide).over(block))
    one = one.where(F.col("first").isNotNull() & F.col("line").between(F.col("first"), F.col("last")))
    # As one struct, a null document is as good a key as another.
    here = F.struct(*PAGE, "line")
    c = c.withColumn("at", here).join(one.select(here.alias("at"), "block", "above"), "at").drop("at")
    across = Window.partitionBy(*PAGE, "block").orderBy("x0", "x1", "line")
    reach = F.max("x1").over(across.rowsBetween(Window.unboundedPreceding, -1))
    c = _steps(c, across, reach.isNull() | (F.col("x0") > reach), "column")
    c = c.withColumn("width", F.max("column").over(block)).where(F.col("width") >= columns)
    rows = c.groupBy(*PAGE, "block", "width", "line").agg(F.min("column").alias("least"), F.max("above").alias("above"), F.array_sort(F.collect_list(F.struct("column", "text"))).alias("c"))
    down = Window.partitionBy(*PAGE, "block").orderBy("line")
    usual = F.percentile_approx(F.when(F.col("least") == 1, F.col("above")), 0.5).over(block)
    rows = rows.withColumn("usual", usual).withColumn("goes_on", (F.col("least") > 1) & (F.col("above") < 0.75 * F.coalesce("usual", F.lit(0.0))) & F.lag("line").over(down).isNotNull())
    rows = _steps(rows, down, ~F.coalesce("goes_on", F.lit(False)) | F.lag("line").over(down).isNull(), "row")
    texts = rows.select(*PAGE, "block", "width", "row", "line", F.inline("c"))
    texts = texts.groupBy(*PAGE, "block", "width", "row", "column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ").alias("text"))
    row = texts.groupBy(*PAGE, "block", "width", "row").agg(F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("by"))
    row = row.select(*PAGE, "block", "row", F.transform(F.sequence(F.lit(1), F.col("width").cast("int")), lambda i: F.coalesce(F.element_at("by", i.cast("long")), F.lit(""))).alias("cells"))
    out = row.groupBy(*PAGE, "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "cells"))), lambda r: r["cells"]).alias("all")).where(F.size("all") >= 2)
    number = (F.row_number().over(Window.partitionBy(*PAGE).orderBy("block")) - 1).cast("int")
    return out.select(*PAGE, number.alias("tbl"), F.get("all", F.lit(0)).alias("header"), F.slice("all", F.lit(2), F.size("all") - 1).alias("rows"))


def read_pdf(spark, path: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """(runs, errors) of the PDF files under a path: doc is the file's name without its ending; errors has path, page and error."""
    from corvina.sources.pdf import PdfRuns

    spark.dataSource.register(PdfRuns)
    rows = spark.read.format("pdf_runs").options(**options).load(path)
    doc = F.regexp_replace(F.regexp_extract("path", "[^/]*$", 0), r"(?i)\.pdf$", "")
    return rows.where("error IS NULL").withColumn("doc", doc), rows.where("error IS NOT NULL").select("path", "page", "error")
