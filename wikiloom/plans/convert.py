"""Page tables and dumps to converted, stored wikis."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wikiloom.config import Languages, Options
from wikiloom.functions.convert import convert_steps
from wikiloom.functions.expr import apply_steps
from wikiloom.operators.counts import assign_ids, shard_emitted
from wikiloom.operators.routing import (ARTICLE, BROKEN, REDIRECT, article_pages, guess_wikitype, route_pages, select_titles)
from wikiloom.operators.search import title_index
from wikiloom.sinks.tables import COMPRESSION, ROWS_PER_FILE, write_by_title, write_metadata, write_title_index
from wikiloom.sources.dump import broken_pages, read_pages, read_siteinfo


def html_columns(options: Options = Options(), languages: Languages | None = None, wikitype: Column | None = None) -> list[Column]:
    """The steps of ``add_html``; building them takes seconds, so a stream does it once for all its batches."""
    return [step(F.col("html")) for step in convert_steps(F.col("lang"), options, languages, wikitype)]


def add_html(pages: DataFrame, options: Options = Options(), languages: Languages | None = None,
             wikitype: Column | None = None, columns: Sequence[Column] | None = None) -> DataFrame:
    """Adds ``html``, converted from ``wikitext`` by the page's ``lang``; ``columns``: the ``html_columns``, if they are at hand."""
    columns = html_columns(options, languages, wikitype) if columns is None else columns
    return apply_steps(pages.withColumn("html", F.col("wikitext")), "html", [lambda _, c=c: c for c in columns])


def convert_articles(pages: DataFrame, options: Options = Options(),
                     languages: Languages | None = None) -> DataFrame:
    """``page_id, title, html`` of the pages that are articles."""
    return add_html(article_pages(pages, languages), options, languages).select("page_id", "title", "html")


def show_articles(pages: DataFrame, titles: Sequence[str] | str, convert: bool = True,
                  options: Options = Options()) -> DataFrame:
    """``title, body`` of chosen pages, converted or in wikicode."""
    chosen = select_titles(pages, titles)
    if not convert:
        return chosen.select("title", F.col("wikitext").alias("body"))
    return add_html(chosen, options).select("title", F.col("html").alias("body"))


def emitted_rows(pages: DataFrame, options: Options = Options(), languages: Languages | None = None,
                 wikitype: Column | None = None, max_articles: int | None = None) -> DataFrame:
    """Articles and redirects in one table: ``page_id, title, title_to, html, kind``.

    With ``max_articles`` also ``shard`` and ``shard_article_id``; pages move to
    their shards before they are converted.
    """
    routed = route_pages(pages, languages, wikitype)
    return convert_routed(routed, options, languages, wikitype, max_articles)


def convert_routed(routed: DataFrame, options: Options = Options(), languages: Languages | None = None, wikitype: Column | None = None,
                   max_articles: int | None = None, columns: Sequence[Column] | None = None) -> DataFrame:
    """``emitted_rows`` of pages that have their ``kind``; broken records keep the column ``broken``."""
    kinds = [ARTICLE, REDIRECT] + ([BROKEN] if "broken" in routed.columns else [])
    routed = routed.where(F.col("kind").isin(kinds))
    sharded = [] if max_articles is None else ["shard", "shard_article_id"]
    routed = routed if max_articles is None else shard_emitted(routed, max_articles)
    # Redirects have no text to convert; null passes all steps.
    text_only = F.when(F.col("kind") == ARTICLE, F.col("wikitext"))
    return add_html(routed.withColumn("wikitext", text_only), options, languages, wikitype, columns).select(
        "page_id", "title", F.when(F.col("kind") == REDIRECT, F.col("redirect_to")).alias("title_to"),
        "html", "kind", *sharded, *(["broken"] if "broken" in routed.columns else []))


class CountMismatch(RuntimeError):
    """Written rows differ from announced rows."""


@dataclass(frozen=True)
class RunCounts:
    articles: int
    redirects: int
    broken: int = 0


def stored_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/pages").where(F.col("kind") == ARTICLE).select("page_id", "title", "html")


def stored_redirects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/pages").where(F.col("kind") == REDIRECT).select(
        F.col("title").alias("title_from"), "title_to")


def stored_shards(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a wiki stored in shards."""
    return spark.read.parquet(f"{path}/pages").withColumn("shard", F.col("shard").cast("long"))


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """``kind, n`` of the stored rows; reads file footers and folder names only."""
    return spark.read.parquet(f"{path}/pages").groupBy("kind").agg(F.count("*").alias("n"))


def reconcile(announced: RunCounts, written: RunCounts) -> None:
    if announced != written:
        raise CountMismatch(f"announced {announced}, written {written}")


def write_wiki(pages: DataFrame, path: str, options: Options = Options(),
               languages: Languages | None = None, metadata: dict[str, str] | None = None,
               overwrite: bool = False, wikitype: Column | None = None, max_articles: int | None = None) -> RunCounts:
    """Convert and store a wiki in one pass over its pages.

    With ``max_articles`` there is a folder per shard of so many articles, and
    a pass before that counts the pages; see ``shard_emitted``.

    The pages are routed on the way in, where they are counted, and written
    into one folder per kind. The counts must agree with what is stored. A wiki
    that is there already is replaced only if ``overwrite`` says so. Language
    rules and namespaces hold for the wiki type of the registry; ``wikitype``
    is taken to be that one unless it is given.
    """
    spark = pages.sparkSession
    seen = Observation()
    routed = route_pages(pages, languages, wikitype).observe(
        seen,
        F.count_if(F.col("kind") == ARTICLE).alias("articles"),
        F.count_if(F.col("kind") == REDIRECT).alias("redirects"))
    folders = ["kind"] if max_articles is None else ["shard", "kind"]
    (emitted_rows(routed, options, languages, wikitype, max_articles).write.mode("overwrite" if overwrite else "errorifexists")
     .option("compression", COMPRESSION).option("maxRecordsPerFile", ROWS_PER_FILE)
     .partitionBy(*folders).parquet(f"{path}/pages"))
    announced = RunCounts(seen.get["articles"], seen.get["redirects"])
    written = {row["kind"]: row["n"] for row in stored_counts(spark, path).collect()}
    reconcile(announced, RunCounts(written.get(ARTICLE, 0), written.get(REDIRECT, 0)))
    if metadata is not None:
        write_metadata(spark, metadata, f"{path}/metadata")
    return announced


def convert_dump(spark: SparkSession, dump: str, path: str, names: DataFrame | None = None, author: str = "unknown",
                 options: Options = Options(), languages: Languages | None = None, overwrite: bool = False,
                 max_articles: int | None = None, on_broken: str = "raise") -> RunCounts:
    """A dump to a stored wiki that can be searched.

    Language and wiki type come from the dump's header. Below ``path``:
    ``pages`` (articles and redirects), ``titles`` (``article_id, page_id,
    title`` with dense ids in page order, laid out by title), ``index`` (tokens
    of the titles) and ``metadata``. ``names(code, english, local)`` supplies
    the names of the language; without it they are its code. ``max_articles``
    splits ``pages`` into shards, as in ``write_wiki``. A page that cannot be
    parsed stops the run; with ``on_broken="skip"`` it goes to ``broken``.
    """
    info = read_siteinfo(spark, dump, names, author)
    info = {**info, "lang-english": info["lang-english"] or info["lang"], "lang-local": info["lang-local"] or info["lang"]}
    wikitype = guess_wikitype(F.lit(info["base"]))
    pages = read_pages(spark, dump, info["lang"], on_broken)
    counts = write_wiki(pages, path, options, languages, info, overwrite, wikitype, max_articles)
    mode = "overwrite" if overwrite else "errorifexists"
    if on_broken == "skip":
        broken_pages(spark, dump).write.mode(mode).option("compression", COMPRESSION).parquet(f"{path}/broken")
        counts = replace(counts, broken=spark.read.parquet(f"{path}/broken").count())
    numbered = assign_ids(stored_articles(spark, path).select("page_id", "title"))
    write_by_title(numbered.select("article_id", "page_id", "title"), f"{path}/titles", mode=mode)
    write_title_index(title_index(stored_titles(spark, path)), f"{path}/index", mode=mode)
    return counts


def stored_titles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/titles")
