"""Queries for web pages read by their elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.plans.catalog import query, table
from corvina.sources import html

PREFIX = r"Plano\s+de\s+Transforma[çc][ãa]o\s+Digital"
KINDS = (("directive", ("diretivo",)), ("delivery", ("entregas", "anexo")))


@query("page_bodies", """
WITH own AS (SELECT page_id, unnest(['P' || page_id || 'A', 'Q' || page_id]) AS owner, 'Plano de Transformação Digital P' || page_id || 'A / Q' || page_id || ':' AS name, 'https://h/x/ptds-vigentes/' || page_id || '.pdf' AS first,
  CASE WHEN page_id % 3 > 0 THEN 'http://h/ptds-vigentes/anexo-' || page_id || '.PDF' END AS second FROM pages),
g AS (SELECT 'Q' || n_nationkey AS head, 'N' || n_nationkey || 'X' AS member FROM nation)
SELECT * , CAST(NULL AS VARCHAR) AS inherited_from FROM own UNION ALL SELECT page_id, g.member, name, first, second, head FROM own JOIN g ON owner = head""")
def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies that a section behind each page names, its documents, and the bodies that share them."""
    k = F.col("page_id").cast("string")
    section = F.concat(
        F.lit("<table><td><strong>Plano de Transforma&ccedil;&atilde;o <em>Digital</em> P"), k, F.lit("A / Q"), k, F.lit(":</strong> <a href='/x/ptds-vigentes/"), k, F.lit(".pdf'>Documento <i>Diretivo</i></a> / "),
        F.when(F.col("page_id") % 3 > 0, F.concat(F.lit('<a class=k href="http://h/ptds-vigentes/anexo-'), k, F.lit('.PDF">baixar &amp; ler</a>'))).otherwise('<a href="/x/ptds-vigentes/z.html">Anexo</a>'), F.lit('</td><td><a href="/x/ptds-vigentes/other.pdf">Entregas</a></td></table>'),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), section).alias("html"))
    groups = table(spark, sf_dir, "nation").select(F.concat(F.lit("Q"), "n_nationkey").alias("head"), F.concat(F.lit("N"), "n_nationkey", F.lit("X")).alias("member"))
    return html.bodies(pages, "page_id", "html", prefix=PREFIX, says="transformacao digital", kinds=KINDS, folders=("ptds-vigentes/",), site="https://h", groups=groups)
