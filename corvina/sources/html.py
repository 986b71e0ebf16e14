"""HTML pages as marks: the headings and links they show, and which elements hold them.

A page is read once from start to end by the library's tokeniser; what stands open at a mark is all that is
kept. Which links belong to which heading, and whose they are, is left to joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.text import fold_key, header_codes, link_kind
from corvina.operators.groups import expand_members

MARKS = "seq int, kind string, inside array<int>, href string, text string"
# Elements without an end, and those whose text is no text.
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style"))


class _Marks(HTMLParser):
    def __init__(self, headings: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.headings = headings
        self.open: list[tuple[int, str]] = []
        self.marks: list[dict] = []
        self.waiting: list[tuple[int, dict]] = []
        self.n = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.n += 1
        href = dict(attrs).get("href")
        if tag in self.headings or tag == "a" and href is not None:
            mark = {"seq": self.n, "kind": "link" if tag == "a" else "heading", "inside": [i for i, _ in self.open], "href": href if tag == "a" else None, "text": []}
            self.marks.append(mark)
            if tag not in EMPTY:
                self.waiting.append((self.n, mark))
        if tag not in EMPTY:
            self.open.append((self.n, tag))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][1] == tag:
                first = self.open[k][0]
                del self.open[k:]
                self.waiting = [(i, m) for i, m in self.waiting if i < first]
                return

    def handle_data(self, data: str) -> None:
        if (piece := data.strip()) and not any(t in SILENT for _, t in self.open):
            for _, mark in self.waiting:
                mark["text"].append(piece)


def page_marks(pages: DataFrame, key: str, html: str, *, headings: Sequence[str] = ("strong", "b")) -> DataFrame:
    """(key, seq, kind, inside, href, text) of every heading and every link with an address, in the order of the page.

    inside numbers the elements that hold the mark, the outermost first; text joins its pieces by blanks. An end tag
    closes what stands open within its element; one without a beginning is ignored. Null pages have no marks.
    """
    rows = pages.where(F.col(html).isNotNull()).select(F.col(key).alias("key"), F.col(html).alias("html"))
    named = frozenset(headings)
    kinds = [("seq", pa.int32()), ("kind", pa.string()), ("inside", pa.list_(pa.int32())), ("href", pa.string()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                reader = _Marks(named)
                reader.feed(batch.column(1)[i].as_py())
                reader.close()
                if reader.marks:
                    own = [pa.array([" ".join(m["text"]) if c == "text" else m[c] for m in reader.marks], t) for c, t in kinds]
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py()] * len(reader.marks), batch.column(0).type), *own], ["key", *(c for c, _ in kinds)])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, {MARKS}").withColumnRenamed("key", key)


def bodies(pages: DataFrame, key: str, html: str, *, prefix: str, says: str, kinds: Sequence[tuple[str, Sequence[str]]], folders: Sequence[str], site: str, groups: DataFrame) -> DataFrame:
    """(key, owner, name, first, second, inherited_from): the bodies that a page's headings name, and where their two documents are.

    A heading counts if its folded text holds ``says`` and codes follow ``prefix``; a repeated set of codes counts once. Its links
    are those to PDF files in ``folders`` within the element that holds it. ``kinds`` are the two kinds of documents with the words
    of their links or file names; a link of neither kind fills the first free place. Addresses from the root get ``site``.
    A body that several headings name keeps the first; members of ``groups`` (head, member) take their head's documents where
    they have none of their own.
    """
    marks = page_marks(pages, key, html)
    heads = marks.where("kind = 'heading'").select(F.col(key).alias("k"), "seq", F.element_at("inside", -1).alias("parent"), F.col("text").alias("name"), header_codes(F.col("text"), prefix).alias("codes"))
    heads = heads.where(fold_key(F.col("name")).contains(says) & (F.size("codes") > 0)).withColumn("set", F.array_sort("codes"))
    first = Window.partitionBy("k", "set").orderBy("seq")
    heads = heads.withColumn("r", F.row_number().over(first)).where("r = 1").drop("r", "set")
    href = F.col("href")
    links = marks.where((F.col("kind") == "link") & F.lower(href).endswith(".pdf") & F.exists(F.array(*map(F.lit, folders)), lambda f: F.contains(href, f)))
    links = links.select(F.col(key).alias("lk"), "inside", F.struct(F.col("seq").alias("at"), F.when(href.startswith("/"), F.concat(F.lit(site), href)).otherwise(href).alias("href"), link_kind(F.col("text"), href, kinds).alias("kind")).alias("link"))
    links = links.select("lk", "link", F.explode("inside").alias("holder"))
    state = "struct<first:string,second:string>"
    places = lambda a, b: F.struct(a.alias("first"), b.alias("second")).cast(state)
    one, two = (k for k, _ in kinds)

    def put(s: Column, x: Column) -> Column:
        free_1, free_2, any_ = s["first"].isNull(), s["second"].isNull(), x["kind"].isNull()
        return F.when(free_1 & (any_ | (x["kind"] == one)), places(x["href"], s["second"])).when(free_2 & (any_ | (x["kind"] == two)), places(s["first"], x["href"])).otherwise(s)

    held = heads.join(links, F.col("k").eqNullSafe(F.col("lk")) & (F.col("parent") == F.col("holder")), "left")
    found = held.groupBy("k", "seq", "name", "codes").agg(F.aggregate(F.array_sort(F.collect_list("link")), places(F.lit(None), F.lit(None)), put).alias("p"))
    each = found.select("k", "seq", "name", "p", F.explode("codes").alias("owner")).groupBy("k", "owner").agg(F.min_by(F.struct("name", "p.first", "p.second"), "seq").alias("x"))
    each = each.select("k", "owner", "x.*")
    # Bodies of several pages are told apart by the page, so groups are expanded page by page.
    whole = each.select(F.struct("k", "owner").alias("owner"), "name", "first", "second")
    here = lambda owner: F.struct("k", F.col(owner).alias("owner"))
    wide = groups.join(each.select("k", F.col("owner").alias("head")), "head").select(here("head").alias("head"), here("member").alias("member"))
    out = expand_members(whole, wide, "owner", "name", "first", "second")
    return out.select(F.col("owner.k").alias(key), F.col("owner.owner").alias("owner"), "name", "first", "second", F.col("inherited_from.owner").alias("inherited_from"))
