"""Filters, predicates and lookups on the page table.

Pages: ``page_id, title, redirect_to, lang, wikitext``; articles:
``page_id, title, html``; redirects: ``title_from, title_to``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.config import REQUIRED_METADATA, Languages, standard_languages
from wikiloom.functions.convert import speaks

REDIRECT, ARTICLE, DROPPED, BROKEN = "redirect", "article", "dropped", "broken"


def is_redirect(target: Column) -> Column:
    return F.coalesce(target != "", F.lit(False))


def is_non_empty(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def title_prefix(title: Column) -> Column:
    """Text before the first colon; null without one or when it comes first."""
    return F.when(F.instr(title, ":") > 1, F.substring_index(title, ":", 1))


def allowed_title(title: Column, lang: Column, wikitype: Column | None = None,
                  languages: Languages | None = None) -> Column:
    """False for titles in a namespace that the language leaves out."""
    languages = languages or standard_languages()
    wikitype = F.lit(languages.wikitype) if wikitype is None else wikitype
    prefix = title_prefix(title)
    listed = prefix.isin(*languages.default.namespaces)
    for language in languages.special():
        listed = F.when(speaks(language.code, lang, wikitype, languages),
                        prefix.isin(*language.namespaces)).otherwise(listed)
    return F.coalesce(~listed, F.lit(True))


def page_kind(languages: Languages | None = None, wikitype: Column | None = None) -> Column:
    """Redirects first, then the body, then the title."""
    keep = is_non_empty(F.col("wikitext")) & allowed_title(F.col("title"), F.col("lang"), wikitype, languages)
    return F.when(is_redirect(F.col("redirect_to")), REDIRECT).when(keep, ARTICLE).otherwise(DROPPED)


def route_pages(pages: DataFrame, languages: Languages | None = None, wikitype: Column | None = None) -> DataFrame:
    """Adds ``kind``: redirect, article or dropped; broken for records that are kept as such."""
    kind = page_kind(languages, wikitype)
    return pages.withColumn("kind", F.when(F.col("broken").isNotNull(), BROKEN).otherwise(kind) if "broken" in pages.columns else kind)


def redirects(pages: DataFrame) -> DataFrame:
    """Before any title filter, so redirects in hidden namespaces stay."""
    return pages.where(is_redirect(F.col("redirect_to"))).select(
        F.col("title").alias("title_from"), F.col("redirect_to").alias("title_to"))


def non_empty(pages: DataFrame) -> DataFrame:
    return pages.where(is_non_empty(F.col("wikitext")))


def allowed_pages(pages: DataFrame, languages: Languages | None = None) -> DataFrame:
    return pages.where(allowed_title(F.col("title"), F.col("lang"), None, languages))


def article_pages(pages: DataFrame, languages: Languages | None = None) -> DataFrame:
    """Pages that become articles, still in wikicode."""
    return pages.where(page_kind(languages) == ARTICLE)


def lookup_title(df: DataFrame, title: str, order_by: str = "page_id") -> DataFrame:
    """At most one row with this title."""
    return df.where(F.col("title") == title).orderBy(order_by).limit(1)


def lookup_id(df: DataFrame, page_id: int) -> DataFrame:
    return df.where(F.col("page_id") == page_id)


def _wanted(df: DataFrame, titles: Sequence[str] | str) -> DataFrame:
    """The asked-for titles, a list typed by the caller, as a table."""
    if isinstance(titles, str):
        titles = titles.split(",")
    return df.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(titles)], "title string")


def select_titles(df: DataFrame, titles: Sequence[str] | str) -> DataFrame:
    """Rows with one of the titles (a list, or one comma-separated string)."""
    return df.join(F.broadcast(_wanted(df, titles)), "title", "left_semi")


def missing_titles(df: DataFrame, titles: Sequence[str] | str) -> DataFrame:
    """Asked-for titles that the table lacks."""
    wanted = _wanted(df, titles)
    found = df.select("title").join(F.broadcast(wanted), "title", "left_semi").distinct()
    return wanted.join(found, "title", "left_anti")


def guess_wikitype(base: Column) -> Column:
    return F.when(F.contains(base, F.lit("wikipedia.org/wiki")), "wikipedia")


def require_keys(metadata: Mapping[str, str], keys: Sequence[str] = REQUIRED_METADATA) -> None:
    missing = [key for key in keys if not metadata.get(key)]
    if missing:
        raise ValueError(f"required metadata missing: {', '.join(missing)}")


def missing_keys(metadata: DataFrame, by: str, keys: Sequence[str] = REQUIRED_METADATA) -> DataFrame:
    """``by, key`` for each wiki and required key without a value.

    The same check over the metadata of many wikis in one table.
    """
    given = F.collect_set(F.when(F.col("key").isin(*keys) & (F.length("value") > 0), F.col("key")))
    return (metadata.groupBy(by).agg(given.alias("given"))
            .select(by, F.explode(F.array_except(F.array(*map(F.lit, keys)), "given")).alias("key")))
