"""Side tables from article text. All but the census are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions import lines as N
from wikiloom.functions import links as L
from wikiloom.functions.markup import closed_part, code_pattern
from wikiloom.operators.routing import title_prefix

TEMPLATE_NAME = r"\{\{++([^{}|]*)"
_INNERMOST = r"\{\{([^{}]*)\}\}"


def _explode(pages: DataFrame, items: Column, pos: str = "pos") -> DataFrame:
    return pages.select("page_id", F.posexplode(items).alias(pos, "item"))


def _all(pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all("wikitext", F.lit(pattern), F.lit(group))


def extract_links(pages: DataFrame) -> DataFrame:
    """``page_id, pos, target, label, trail, namespace`` of each wiki link.

    ``label`` is the shown text without the trail; ``namespace`` is the part of
    the target before its first colon, empty without one.
    """
    target, label = F.regexp_extract("item", L.LINK, 1), F.regexp_extract("item", L.LINK, 2)
    return (_explode(pages.where(F.contains("wikitext", F.lit("[["))), _all(L.LINK))
            .select("page_id", "pos", target.alias("target"),
                    F.when(label != "", label).otherwise(target).alias("label"),
                    F.regexp_extract("item", L.LINK, 3).alias("trail"))
            .withColumn("namespace", F.coalesce(title_prefix(F.col("target")), F.lit(""))))


def extract_external_links(pages: DataFrame) -> DataFrame:
    """``page_id, pos, url, label``, after the wiki links are taken out."""
    text = pages.withColumn("wikitext", L.links_to_anchors(F.col("wikitext"))).withColumn(
        "wikitext", L.drop_leftover_links(F.col("wikitext")))
    return _explode(text, _all(L.EXTERNAL_PARTS)).select(
        "page_id", "pos",
        F.regexp_extract("item", L.EXTERNAL_PARTS, 1).alias("url"),
        F.regexp_extract("item", L.EXTERNAL_PARTS, 2).alias("label"))


def extract_sections(pages: DataFrame) -> DataFrame:
    """``page_id, pos, level, title``; ``pos`` is the line number from 0."""
    numbered = F.transform(N.lines(F.col("wikitext")),
                           lambda line, i: F.struct(i.alias("pos"), line.alias("line")))
    headings = F.filter(numbered, lambda x: N.is_heading(x["line"]))
    return (pages.where(F.contains("wikitext", F.lit("==")))
            .select("page_id", F.inline(headings))
            .select("page_id", "pos", N.heading_level(F.col("line")).alias("level"),
                    N.heading_title(F.col("line")).alias("title")))


def extract_templates(pages: DataFrame) -> DataFrame:
    """``page_id, pos, name, args`` of templates without templates inside."""
    parts = F.split("item", r"\|", -1)
    return (_explode(pages.where(F.contains("wikitext", F.lit("{{"))), _all(_INNERMOST, 1))
            .select("page_id", "pos", F.trim(F.get(parts, F.lit(0))).alias("name"),
                    F.slice(parts, F.lit(2), F.size(parts)).alias("args")))


def extract_code_blocks(pages: DataFrame) -> DataFrame:
    """``page_id, index, body``; indices start at 1 as in the placeholders."""
    closed = pages.withColumn("wikitext", closed_part(F.col("wikitext"), "code"))
    return (_explode(closed, _all(code_pattern("code")))
            .select("page_id", (F.col("pos") + 1).alias("index"), F.col("item").alias("body")))


def template_census(pages: DataFrame) -> DataFrame:
    """How often each template name occurs, nested ones included."""
    return (pages.where(F.contains("wikitext", F.lit("{{")))
            .select(F.explode(_all(TEMPLATE_NAME, 1)).alias("name"))
            .groupBy(F.lower(F.trim("name")).alias("name")).agg(F.count("*").alias("n")))
