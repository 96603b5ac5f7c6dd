"""MediaWiki XML dumps as page tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_END = "</page>"
BROKEN = "_broken"
PAGE_XML = (
    "title string, ns long, id long, redirect struct<_title:string>, "
    f"revision struct<id:long, text:struct<_VALUE:string>>, {BROKEN} string"
)
SITE_XML = "sitename string, dbname string, base string, generator string"
# Surrounding line breaks belong to the article.
_XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}


def _parsed(records: DataFrame) -> tuple[DataFrame, list[str]]:
    """``raw``, ``page`` and ``is_broken`` for every record with a page, beside further columns."""
    others = [c for c in records.columns if c != "value"]
    start = F.instr("value", "<page>")
    xml = F.concat(F.substring("value", start, F.length("value")), F.lit(PAGE_END))
    rows = records.where(start > 0).select(*others, xml.alias("raw"))
    parsed = rows.withColumn("page", F.from_xml("raw", PAGE_XML, {**_XML_OPTIONS, "rowTag": "page"}))
    broken = F.col("page").isNull() | F.col(f"page.{BROKEN}").isNotNull() | F.col("page.id").isNull() | F.col("page.title").isNull()
    return parsed.withColumn("is_broken", broken), others


def parse_pages(records: DataFrame, on_broken: str = "raise") -> DataFrame:
    """Text records that end before ``</page>`` to one row per page.

    Works on a batch and on a stream. An article cannot hold the tag itself,
    since dumps escape ``<``. Further columns, such as those of a partitioned
    folder, stay. A page that is no XML or has no id or title, such as the last
    one of a dump that was cut off, raises an error; with ``on_broken="skip"``
    it is left out here and found by ``broken_pages``; with ``"keep"`` it is a
    row with the record in the column ``broken``, null for all others.
    """
    if on_broken not in ("raise", "skip", "keep"):
        raise ValueError(f"on_broken: {on_broken!r}")
    parsed, others = _parsed(records)
    page_id = F.col("page.id")
    if on_broken == "skip":
        parsed = parsed.where(~F.col("is_broken"))
    elif on_broken == "raise":
        message = F.concat(F.lit("a page of the dump cannot be parsed: "), F.left("raw", F.lit(300)))
        page_id = F.when(F.col("is_broken"), F.raise_error(message).cast("long")).otherwise(page_id)
    fields = {"page_id": page_id, "title": F.col("page.title"), "ns": F.col("page.ns"), "redirect_to": F.col("page.redirect._title"),
              "revision_id": F.col("page.revision.id"),
              "wikitext": F.when(page_id.isNotNull(), F.col("page.revision.text._VALUE"))}
    if on_broken == "keep":  # nothing of a broken page counts
        fields = {name: F.when(~F.col("is_broken"), value) for name, value in fields.items()}
        fields["broken"] = F.when(F.col("is_broken"), F.col("raw"))
    return parsed.select(*others, *(value.alias(name) for name, value in fields.items()))


def read_pages(spark: SparkSession, path: str, lang: str | None = None, on_broken: str = "raise") -> DataFrame:
    """Pages of a dump file or of a folder of dumps, plain, ``.bz2`` or ``.gz``.

    Splitting the text at ``</page>`` lets many tasks share one file (plain or
    bz2; gz cannot be split, see ``spread``). ``lang`` becomes a column.
    Broken pages: see ``parse_pages``.
    """
    pages = parse_pages(spark.read.text(path, lineSep=PAGE_END), on_broken)
    return pages.withColumn("lang", F.lit(lang)) if lang is not None else pages


def broken_pages(spark: SparkSession, path: str) -> DataFrame:
    """``raw``: the records of a dump that cannot be parsed, for a table of their own."""
    parsed, others = _parsed(spark.read.text(path, lineSep=PAGE_END))
    return parsed.where("is_broken").select(*others, "raw")


def read_siteinfo(spark: SparkSession, path: str, languages: DataFrame | None = None,
                  author: str = "unknown") -> dict[str, str | None]:
    """Header of a dump with the values derived from it.

    Only the first record is read: it holds all that stands before the first
    page. ``languages(code, english, local)`` supplies the language's names.
    """
    head = site_table(spark, path).limit(1).collect()
    if not head or not head[0]["lang"]:
        raise ValueError(f"{path}: not a MediaWiki dump, no <mediawiki … xml:lang=…> at its start")
    info = head[0].asDict()
    names = {"english": None, "local": None}
    if languages is not None:
        code = info["lang"].lower()
        rows = languages.where(F.lower("code") == code).orderBy("english", "local").limit(1).collect()
        if not rows:
            raise ValueError(f"language {info['lang']!r} is not in the language table")
        names = rows[0].asDict()
    return {
        **info,
        "lang-code": info["lang"], "lang-english": names["english"], "lang-local": names["local"],
        "type": info["sitename"], "source": info["base"], "author": author,
    }


def site_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per dump: ``lang, sitename, dbname, base, generator``."""
    return site_rows(spark.read.text(path, lineSep=PAGE_END).select("value"))


def site_rows(records: DataFrame) -> DataFrame:
    """The headers among text records, beside the records' further columns."""
    others = [c for c in records.columns if c != "value"]
    records = records.where(F.contains("value", F.lit("<siteinfo")))
    lang = F.regexp_extract("value", r'<mediawiki[^\n>]*xml:lang="([^"]+)"', 1)
    xml = F.regexp_extract("value", r"(?s)<siteinfo.*</siteinfo>", 0)
    site = F.from_xml(xml, SITE_XML, {"rowTag": "siteinfo"})
    return records.select(*others, lang.alias("lang"), site.alias("site")).select(*others, "lang", "site.*")


def xml_text(text: Column) -> Column:
    """Escape text for XML; carriage returns would not survive reading."""
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def xml_plain(text: Column) -> Column:
    """The text that ``xml_text`` has escaped."""
    for character, entity in (("\r", "&#13;"), ('"', "&quot;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def spread(df: DataFrame, key: str, per_core: int = 3, enough: int = 2) -> DataFrame:
    """Redistribute rows of an input with too few partitions for the cores.

    Small or unsplittable inputs (one gz file, one Parquet row group) would
    keep most cores idle. Inputs with more than ``enough`` partitions a core
    are left as they are; with 0, those with a partition for every core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > max(enough * cores, cores - 1):
        return df
    return df.repartition(per_core * cores, key)
