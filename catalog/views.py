"""Page tables derived from the given tables, as SQL for both engines."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.shared import new_path
from wikiloom.sources.dump import spread, xml_text


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def joined(*parts: str) -> str:
    """``concat`` of SQL expressions and of plain texts, marked by a leading "=" sign."""
    return "concat(" + ", ".join(quote(p[1:]) if p.startswith("=") else p for p in parts) + ")"


ID = "cast(doc_id as string)"
NL = "chr(10)"

_TITLE = (
    f"CASE WHEN doc_id % 40 = 20 THEN concat('Category:Alias ', {ID}) "
    f"WHEN doc_id % 10 = 0 THEN concat('Alias ', {ID}) "
    f"WHEN doc_id % 10 = 3 THEN concat('Category:Doc ', {ID}) "
    f"WHEN doc_id % 10 = 4 THEN concat('Race:Doc ', {ID}) "
    f"ELSE concat('Doc ', {ID}) END"
)
_REDIRECT = (
    "CASE WHEN doc_id % 20 = 10 THEN concat('Alias ', cast(doc_id + 10 as string)) "
    "WHEN doc_id % 10 = 0 THEN concat('Doc ', cast(doc_id + 1 as string)) END"
)
_WIKITEXT = "CASE WHEN doc_id % 20 = 5 THEN '' ELSE " + joined(
    "=== Section ", "cast(doc_id % 5 as string)", "= ==", NL,
    "='''", "lang", "=''' is ''", "source", "='' near [[Doc ", "cast(doc_id + 1 as string)",
    "=|next]]s and [[Doc ", "cast(doc_id + 2 as string)", "=]]. ",
    "=[[File:x", ID, "=.png|thumb|cap]][http://e.org/", ID, "= site] {{date|",
    "cast(doc_id % 28 + 1 as string)", "=|mai|2001}} ",
    "={{box|a={{in|", "cast(doc_id % 3 as string)",
    '=}}}} {| class="t" |} a &amp;lt; b &#233; <!-- c --><ref>r</ref><br/><code>k',
    "cast(doc_id % 2 as string)", "=</code>", NL,
    "=* item....", NL, NL, "text") + " END"

WIKI_PAGES = (
    f"SELECT doc_id AS page_id, {_TITLE} AS title, {_REDIRECT} AS redirect_to, lang, "
    f"{_WIKITEXT} AS wikitext FROM documents"
)

# Every kind of line, quote, link and space that wiki_pages lacks.
RICH_PAGES = "SELECT doc_id AS page_id, lang, " + joined(
    "=++Doc ", ID, "=++", NL, "=++Really ", ID, "=!++", NL, "=++++", NL,
    "=== Section ", "cast(doc_id % 5 as string)", "= ==", NL, "==== Sub ===rest", NL, "==== A == B", NL,
    "='''''both''''' '''bold''' ''\"quote\"'' ''it'' \"\"double\"\" ''open ", NL,
    "=* item ", ID, NL, "=** deep", NL, "=# num", NL, "=*** deeper", NL, "=* back", NL, NL, "=:* ind", NL, "=** again", NL,
    "={ residue", NL, "=| cell", NL, "=end }", NL, "=(aside)", NL, "=.-.", NL, "=%$ -", NL,
    "=<math>x</math> <br/><br/><br/><br/> ,,a ,.b", NL,
    "=[http://e.org/", ID, "= the site] [word] [w&] [http://bare.org] [[A|b]]s [[C]] [[Talk:x|y]]z [[D|]] [[E", NL, "=F", NL,
    "=<code>a", ID, "=</code> <code>b</code> <Code x>a", ID, "=</code> <code>b</code>", NL,
    f"replace(replace(text, ', ', ',,  '), '. ', concat('.....', chr(9), {NL}))",
) + " AS wikitext FROM documents"


def tables(spark: SparkSession, sf_dir: str, *names: str, enough: int = 2) -> None:
    """Register the given tables under their names."""
    for name in names:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        key = {"documents": "doc_id", "pages": "page_id"}[name]
        spread(df, key, enough=enough).createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, sql: str, enough: int = 2) -> DataFrame:
    tables(spark, sf_dir, "documents", "pages", enough=enough)
    return spark.sql(sql)


def wiki_pages(spark: SparkSession, sf_dir: str, enough: int = 2) -> DataFrame:
    return view(spark, sf_dir, WIKI_PAGES, enough)


def rich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, RICH_PAGES)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names for shared data."""
    return new_path(spark, name)


SITE = ("SELECT DISTINCT lang, concat('Wiki ', lang) AS sitename, concat(lang, 'wiki') AS dbname, "
        "concat('https://', lang, '.wikipedia.org/wiki/Main') AS base, 'MediaWiki 1.29' AS generator "
        "FROM documents")

def page_xml() -> Column:
    redirect = F.when(F.col("redirect_to").isNotNull(), F.concat(
        F.lit('    <redirect title="'), xml_text(F.col("redirect_to")), F.lit('" />\n'))).otherwise("")
    return F.concat(
        F.lit("  <page>\n    <title>"), xml_text(F.col("title")), F.lit("</title>\n    <ns>0</ns>\n    <id>"),
        F.col("page_id").cast("string"), F.lit("</id>\n"), redirect,
        F.lit("    <revision>\n      <id>7</id>\n      <contributor><id>9</id></contributor>\n"
              '      <text xml:space="preserve">'),
        xml_text(F.col("wikitext")), F.lit("</text>\n    </revision>\n  </page>"))


def head_xml() -> Column:
    return F.concat(
        F.lit('<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="'),
        F.col("lang"), F.lit('">\n  <siteinfo>\n    <sitename>'), F.col("sitename"),
        F.lit("</sitename>\n    <dbname>"), F.col("dbname"), F.lit("</dbname>\n    <base>"), F.col("base"),
        F.lit("</base>\n    <generator>"), F.col("generator"), F.lit("</generator>\n  </siteinfo>"))


_dumps: dict[tuple[str, str], str] = {}
#: Files that a task keeps open where it writes a folder per value; with more values it sorts its rows.
OPEN_FILES = 64
#: Characters of a dump's part, more or less; a wiki with more text has several.
DUMP_CHARS = 1 << 28


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside deal rows to open files, so nothing is sorted or spilled."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def wiki_dump(spark: SparkSession, sf_dir: str) -> str:
    """The wiki pages as XML dumps, one folder per language; written once, by the tasks that read them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _dumps:
        path = scratch(spark, "dump")
        with open_files(spark):
            wiki_pages(spark, sf_dir, enough=0).select("lang", page_xml().alias("value")).write.partitionBy("lang").text(path)
            spark.sql(SITE).select("lang", head_xml().alias("value")).write.mode("append").partitionBy("lang").text(path)
        _dumps[key] = path
    return _dumps[key]


#: Pages by the header of their dump: the French ones with an even number are of a wiktionary.
IS_WIKTIONARY = "lang = 'fr' AND page_id % 2 = 0"


def whole_dumps(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the dumps of all wikis, large ones in parts, each a file with its header; every seventh page holds an unknown entity."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#whole")
    if key not in _dumps:
        path = scratch(spark, "dumps")
        wiki = F.concat("lang", F.when(F.expr(IS_WIKTIONARY), "wiktionary").otherwise("wikipedia"))
        xml = F.when(F.col("page_id") % 7 == 0, F.replace(page_xml(), F.lit("</text>"), F.lit("&bogus; <</text>"))).otherwise(page_xml())
        pages = wiki_pages(spark, sf_dir, enough=0).withColumn("wiki", wiki)
        parts, n = [], 0
        for row in pages.groupBy("wiki").agg(F.sum(F.length("wikitext")).alias("chars")).orderBy("wiki").collect():  # a handful of wikis
            parts.append((row["wiki"], n, 1 + (row["chars"] or 0) // DUMP_CHARS))
            n += parts[-1][2]
        of_wiki = spark.createDataFrame(parts, "of string, first int, parts int").select(
            "of", "first", "parts", F.left("of", F.lit(2)).alias("lang"), F.col("of").alias("sitename"), F.col("of").alias("dbname"),
            F.concat(F.lit("https://"), F.left("of", F.lit(2)), F.lit("."), F.substring("of", F.lit(3), F.length("of")),
                     F.lit(".org/wiki/Main")).alias("base"), F.lit("MediaWiki 1.29").alias("generator"))
        heads = of_wiki.select(F.col("of").alias("wiki"), F.explode(F.expr("sequence(first, first + parts - 1)")).alias("part"),
                               F.lit(0).alias("place"), head_xml().alias("value"))
        dealt = pages.join(F.broadcast(of_wiki.select("of", "first", "parts")), F.col("wiki").eqNullSafe(F.col("of"))).select(
            "wiki", F.expr("cast(first + pmod(xxhash64(page_id), parts) as int)").alias("part"), F.lit(1).alias("place"), xml.alias("value"))
        (heads.unionByName(dealt).repartitionById(max(n, 1), F.col("part")).sortWithinPartitions("wiki", "place").select("wiki", "value")
         .write.partitionBy("wiki").text(path))
        _dumps[key] = path
    return _dumps[key]
