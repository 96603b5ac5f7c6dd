"""Sources, sinks, filters, joins, counts, side tables, search and streaming."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.text import (ARTICLES_SQL, IS_HEADING, HEADING_TITLE, LEVEL, ROUTED, replaced, sql_anchors,
                          sql_numbered, LEFTOVER)
from catalog.views import (IS_WIKTIONARY, RICH_PAGES, SITE, WIKI_PAGES, quote, rich_pages, scratch, view, whole_dumps, wiki_dump,
                           wiki_pages)
from wikiloom.functions.convert import apply_rules
from wikiloom.operators import counts as A
from wikiloom.operators import extract as D
from wikiloom.operators import lookups as J
from wikiloom.operators import routing as P
from wikiloom.operators import search as X
from wikiloom.plans.convert import (convert_articles, convert_dump, emitted_rows, show_articles, stored_articles,
                                    stored_counts, stored_shards, stored_titles, write_wiki)
from wikiloom.sinks import tables as K
from wikiloom.sources import dump as S
from wikiloom.sources.places import fetch_pages, page_places
from wikiloom.sources.tables import page_directory, read_metadata, unique_metadata
from wikiloom.streaming.ingest import ingest, ingest_dumps, ingested, quarantined, run_metrics, stream_pages
from wikiloom.streaming.titles import compact_index, growing_index, growing_titles, id_ranges

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that checks it."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def over(source: str, select: str, rest: str = "") -> str:
    return f"WITH p AS ({source}) SELECT {select} FROM p {rest}"


MAX_ARTICLES = 150
PAGES = "page_id, title, redirect_to, lang, wikitext"
REDIRECTS = "title AS title_from, redirect_to AS title_to"


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.route_pages(wiki_pages(spark, sf_dir))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.article_pages(wiki_pages(spark, sf_dir))


def _redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.redirects(wiki_pages(spark, sf_dir))


# --- sources ---------------------------------------------------------------

@query(over(WIKI_PAGES, PAGES))
def s01_read_pages(spark, sf_dir):
    pages = S.read_pages(spark, wiki_dump(spark, sf_dir))
    return pages.withColumn("wikitext", F.coalesce("wikitext", F.lit(""))).select(*PAGES.split(", "))


@query(SITE)
def s02_siteinfo(spark, sf_dir):
    return S.site_table(spark, wiki_dump(spark, sf_dir))


def _packed(spark, sf_dir, codec):
    """The dump once more, as compressed text files."""
    path = scratch(spark, codec)
    dump = spark.read.text(wiki_dump(spark, sf_dir), lineSep=S.PAGE_END).where(F.contains("value", F.lit("<page>")))
    whole = F.concat("value", F.lit(S.PAGE_END))
    dump.select("lang", whole.alias("value")).write.partitionBy("lang").option("compression", codec).text(path)
    return S.read_pages(spark, path)


def _with_text_of(pages):
    return pages.withColumn("wikitext", F.coalesce("wikitext", F.lit("")))


def _with_text(pages):
    return _with_text_of(pages).select(*PAGES.split(", "))


@query(over(WIKI_PAGES, PAGES))
def s03_read_dump_gz(spark, sf_dir):
    return _with_text(S.spread(_packed(spark, sf_dir, "gzip"), "page_id"))


@query(over(WIKI_PAGES, PAGES))
def s03_read_dump_bz2(spark, sf_dir):
    return _with_text(_packed(spark, sf_dir, "bzip2"))


@query("SELECT doc_id AS page_id FROM documents WHERE doc_id % 7 = 0")
def s01_broken_pages(spark, sf_dir):
    """A dump in which every seventh page holds an unknown entity: the records that cannot be parsed."""
    path = scratch(spark, "broken")
    value, page_id = F.col("value"), F.regexp_extract("value", r"<id>(\d+)</id>", 1).cast("long")
    bad = F.replace(value, F.lit("</text>"), F.lit("&bogus; <</text>"))
    records = spark.read.text(wiki_dump(spark, sf_dir), lineSep=S.PAGE_END).where(F.contains("value", F.lit("<page>")))
    records.select(F.concat(F.when(page_id % 7 == 0, bad).otherwise(value), F.lit(S.PAGE_END)).alias("value")).write.text(path)
    return S.broken_pages(spark, path).select(F.regexp_extract("raw", r"<id>(\d+)</id>", 1).cast("long").alias("page_id"))


METADATA_SQL = (
    f"WITH s AS ({SITE}) SELECT lang, unnest(['lang-code', 'lang-local', 'lang-english', 'version', 'source', "
    "'author', 'type']) AS key, unnest([lang, concat('Local ', lang), concat('English ', lang), '2.5', base, "
    "'tester', sitename]) AS value FROM s")
LANGUAGES = ("SELECT DISTINCT upper(lang) AS code, concat('English ', lang) AS english, "
             "concat('Local ', lang) AS local FROM documents")


@cache
def _metadata_paths(application: str, sf_dir: str) -> dict[str, str]:
    """Metadata of the dump of each language, written as a table each."""
    spark = SparkSession.active()
    dump = wiki_dump(spark, sf_dir)
    names = view(spark, sf_dir, LANGUAGES)
    paths = {}
    for code in sorted(row["code"].lower() for row in names.collect()):  # a handful of wikis
        infos = S.read_siteinfo(spark, f"{dump}/lang={code}", names, author="tester")
        paths[code] = scratch(spark, f"metadata-{code}")
        K.write_metadata(spark, infos, paths[code])
    return paths


@query(METADATA_SQL)
def s04_read_metadata(spark, sf_dir):
    paths = _metadata_paths(spark.sparkContext.applicationId, sf_dir)
    rows = [(code, key, value) for code, path in paths.items()
            for key, value in read_metadata(spark, path).items() if key != "date"]
    return spark.createDataFrame(rows, "lang string, key string, value string")


@query(METADATA_SQL)
def k03_write_metadata(spark, sf_dir):
    paths = _metadata_paths(spark.sparkContext.applicationId, sf_dir)
    tables = [unique_metadata(spark.read.parquet(path)).withColumn("lang", F.lit(code))
              for code, path in paths.items()]
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged.where(F.col("key") != "date").select("lang", "key", "value")


@query(over(WIKI_PAGES, "page_id, title, CASE WHEN instr(title, ':') > 1 THEN split_part(title, ':', 1) ELSE '' END AS ns, "
            "cast(length(wikitext) AS INTEGER) AS n_chars, concat('lang=', lang) AS folder"))
def s05_page_directory(spark, sf_dir):
    """Over the dumps; of the file's name the folder is checked."""
    directory = page_directory(S.read_pages(spark, wiki_dump(spark, sf_dir)))
    return directory.withColumn("folder", F.element_at(F.split("input_file", "/"), -2)).drop("input_file")


@query(over(WIKI_PAGES, PAGES + ", title AS listed_title"))
def s05_page_places(spark, sf_dir):
    """All pages, each fetched from its place in the dump."""
    places = page_places(spark, wiki_dump(spark, sf_dir))
    return _with_text_of(fetch_pages(places.withColumn("listed_title", F.col("title")))).select(*PAGES.split(", "), "listed_title")


@query(over(WIKI_PAGES, PAGES, f"WHERE title IN ({', '.join(quote(t) for t in ('Doc 1', 'Race:Doc 4', 'Alias 10'))})"))
def s05_fetch_titles(spark, sf_dir):
    """Pages with the given titles, found in the directory of places."""
    places = page_places(spark, wiki_dump(spark, sf_dir))
    return _with_text(fetch_pages(P.select_titles(places, ["Doc 1", "Race:Doc 4", "Alias 10"])))


# --- sinks -----------------------------------------------------------------

@query(ARTICLES_SQL)
def k01_write_articles(spark, sf_dir):
    path = scratch(spark, "articles")
    K.write_articles(convert_articles(wiki_pages(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query(over(WIKI_PAGES, REDIRECTS, "WHERE redirect_to <> ''"))
def k02_write_redirects(spark, sf_dir):
    path = scratch(spark, "redirects")
    K.write_redirects(_redirects(spark, sf_dir), path)
    return spark.read.parquet(path)


SHARDED = f"""
WITH r AS ({ROUTED}),
e AS (SELECT page_id, title, kind, sum(CASE WHEN kind = 'article' THEN 1 ELSE 0 END) OVER (ORDER BY page_id) AS seen,
        sum(CASE WHEN kind = 'article' THEN 1 ELSE 0 END) OVER () AS total
      FROM r WHERE kind <> 'dropped'),
s AS (SELECT page_id, title, kind, cast(least(
        (CASE WHEN kind = 'article' THEN seen - 1 ELSE seen END) // {MAX_ARTICLES},
        greatest((total - 1) // {MAX_ARTICLES}, 0)) AS BIGINT) AS shard FROM e)
"""


@query(SHARDED + f"SELECT s.page_id, s.title, s.kind, shard, CASE WHEN s.kind = 'article' THEN row_number() OVER "
       "(PARTITION BY shard, s.kind ORDER BY s.page_id) END AS shard_article_id, html "
       f"FROM s LEFT JOIN ({ARTICLES_SQL}) AS h ON s.page_id = h.page_id")
def k04_write_sharded(spark, sf_dir):
    path = scratch(spark, "shards")
    write_wiki(wiki_pages(spark, sf_dir), path, max_articles=MAX_ARTICLES)
    return stored_shards(spark, path).select("page_id", "title", "kind", "shard", "shard_article_id", "html")


def _split(spark, sf_dir, n):
    """Written in parts and read back."""
    path = scratch(spark, "parts")
    K.write_sharded(A.split_table(_articles(spark, sf_dir).select("page_id", "title"), n), path, by="part")
    return spark.read.parquet(path).withColumn("part", F.col("part").cast("long"))


@query(over(f"SELECT page_id, title FROM ({ROUTED}) AS r WHERE kind = 'article'",
            "page_id, title, cast(ntile(2) OVER (ORDER BY page_id) AS BIGINT) AS part"))
def k05_split_table(spark, sf_dir):
    return _split(spark, sf_dir, 2)


@query(over(f"SELECT page_id, title FROM ({ROUTED}) AS r WHERE kind = 'article'",
            "page_id, title, cast(ntile(7) OVER (ORDER BY page_id) AS BIGINT) AS part"))
def k05_split_table_7(spark, sf_dir):
    return _split(spark, sf_dir, 7)


@query(over(WIKI_PAGES, "page_id, title, wikitext"))
def k06_write_by_title(spark, sf_dir):
    path = scratch(spark, "by-title")
    K.write_by_title(wiki_pages(spark, sf_dir).select("page_id", "title", "wikitext"), path)
    return spark.read.parquet(path)


@query(f"WITH a AS (SELECT page_id, title FROM ({ROUTED}) AS q WHERE kind = 'article'), r AS (SELECT {REDIRECTS} FROM ({WIKI_PAGES}) AS w "
       "WHERE redirect_to <> '') SELECT title_from, title_to, page_id FROM r LEFT JOIN a ON title_to = title")
def k06_bucketed_join(spark, sf_dir):
    """Redirects with the articles they lead to, both stored in buckets of the title: no rows move."""
    redirects, articles = scratch(spark, "redirects"), scratch(spark, "articles")
    names = [path.rsplit("/", 1)[1].replace("-", "_") for path in (redirects, articles)]
    K.write_bucketed(_redirects(spark, sf_dir), names[0], 8, "title_to", path=redirects)
    K.write_bucketed(_articles(spark, sf_dir).select("page_id", "title"), names[1], 8, path=articles)
    left, right = (spark.table(name) for name in names)
    return left.join(right.hint("merge"), F.col("title_to") == F.col("title"), "left").select("title_from", "title_to", "page_id")


@query(ARTICLES_SQL)
def k07_compressed_storage(spark, sf_dir):
    path = scratch(spark, "wiki")
    write_wiki(wiki_pages(spark, sf_dir), path)
    return stored_articles(spark, path)


@query(f"SELECT lang, page_id, title, article_id, html FROM (SELECT lang, page_id, title, row_number() OVER "
       f"(PARTITION BY lang ORDER BY page_id) AS article_id FROM ({ROUTED}) AS r WHERE kind = 'article') AS i "
       f"JOIN ({ARTICLES_SQL}) AS h USING (page_id, title)")
def k07_convert_dump(spark, sf_dir):
    """The dump of each wiki, converted in one call and read back: titles with ids, and html."""
    dump, path = wiki_dump(spark, sf_dir), scratch(spark, "wikis")
    codes = [row["lang"] for row in S.site_table(spark, dump).select("lang").distinct().collect()]  # a handful of wikis
    for code in codes:
        convert_dump(spark, f"{dump}/lang={code}", f"{path}/{code}")
    wikis = [stored_titles(spark, f"{path}/{code}").join(stored_articles(spark, f"{path}/{code}"), ["page_id", "title"])
             .withColumn("lang", F.lit(code)) for code in codes]
    return reduce(DataFrame.unionByName, wikis)


TITLES = "Doc 1,Race:Doc 4,Doc 6,No such title"
IN_TITLES = "title IN (" + ", ".join(quote(t) for t in TITLES.split(",")) + ")"


@query(f"SELECT title, html AS body FROM ({ARTICLES_SQL}) AS a WHERE {IN_TITLES}")
def k08_show_articles(spark, sf_dir):
    return show_articles(_articles(spark, sf_dir), TITLES)


@query(over(WIKI_PAGES, "title, wikitext AS body", f"WHERE {IN_TITLES}"))
def k08_show_articles_original(spark, sf_dir):
    return show_articles(wiki_pages(spark, sf_dir), TITLES, convert=False)


# --- filters and predicates ------------------------------------------------

@query(over(ROUTED, "page_id, title, kind"))
def p01_route_pages(spark, sf_dir):
    return _routed(spark, sf_dir).select("page_id", "title", "kind")


@query(over(WIKI_PAGES, REDIRECTS, "WHERE redirect_to <> ''"))
def p02_redirects(spark, sf_dir):
    return _redirects(spark, sf_dir)


@query(over(WIKI_PAGES, PAGES, "WHERE length(wikitext) > 0"))
def p03_non_empty(spark, sf_dir):
    return P.non_empty(wiki_pages(spark, sf_dir))


@query(over(ROUTED, PAGES, "WHERE kind = 'article' OR NOT (instr(title, ':') > 1 AND lang <> 'fr' "
            "AND split_part(title, ':', 1) = 'Category')"))
def p04_allowed_title(spark, sf_dir):
    return P.allowed_pages(wiki_pages(spark, sf_dir))


@query(over(WIKI_PAGES, PAGES, "WHERE title = 'Doc 7' ORDER BY page_id LIMIT 1"))
def p05_lookup_title(spark, sf_dir):
    return P.lookup_title(wiki_pages(spark, sf_dir), "Doc 7")


@query(over(WIKI_PAGES, PAGES, f"WHERE {IN_TITLES}"))
def p06_select_titles(spark, sf_dir):
    return P.select_titles(wiki_pages(spark, sf_dir), TITLES)


@query(f"WITH p AS ({WIKI_PAGES}) SELECT t AS title FROM (SELECT unnest(string_split({quote(TITLES)}, ',')) AS t) AS w "
       "WHERE t NOT IN (SELECT title FROM p)")
def p06_missing_titles(spark, sf_dir):
    return P.missing_titles(wiki_pages(spark, sf_dir), TITLES)


@query(over(WIKI_PAGES, PAGES, "WHERE page_id = 12"))
def p07_lookup_id(spark, sf_dir):
    return P.lookup_id(wiki_pages(spark, sf_dir), 12)


_TYPE = "CASE WHEN lang IN ('fr', 'en') THEN 'wikipedia' ELSE 'wiktionary' END"


@query(over(WIKI_PAGES, "page_id, CASE WHEN lang = 'fr' THEN "
            + replaced("wikitext", (r"\{\{date\|1\|", "{{date|1er|"), (r"\{\{date\|(\w+)\|(\w+)\|(\d+)\}\}", r"\1 \2 \3"))
            + " ELSE wikitext END AS text"))
def p08_rules_for(spark, sf_dir):
    """French rules on the French wikipedia only."""
    pages = wiki_pages(spark, sf_dir)
    return pages.select("page_id", apply_rules(F.col("wikitext"), F.col("lang"), F.expr(_TYPE)).alias("text"))


_BASE = "concat('https://', lang, CASE WHEN lang IN ('fr', 'en') THEN '.wikipedia' ELSE '.wiktionary' END, '.org/wiki/', title)"


@query(over(WIKI_PAGES, "page_id, CASE WHEN lang IN ('fr', 'en') THEN 'wikipedia' END AS wikitype"))
def p09_guess_wikitype(spark, sf_dir):
    return wiki_pages(spark, sf_dir).select("page_id", P.guess_wikitype(F.expr(_BASE)).alias("wikitype"))


_INFOS = ("SELECT source AS wiki, unnest(['lang-code', 'type', 'source']) AS key, "
          "unnest([lang, CASE WHEN n_chars % 2 = 0 THEN '' ELSE 'wiki' END, CASE WHEN lang = 'en' THEN source END]) "
          "AS value FROM documents")
_KEYS = "unnest(['lang-code', 'lang-local', 'lang-english', 'type', 'source', 'author'])"


@query(f"WITH m AS ({_INFOS}), k AS (SELECT DISTINCT wiki FROM m), r AS (SELECT wiki, {_KEYS} AS key FROM k) "
       "SELECT wiki, key FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.wiki = r.wiki AND m.key = r.key AND m.value <> '')")
def p10_require_keys(spark, sf_dir):
    """Required keys that each source's documents fail to give."""
    infos = view(spark, sf_dir, "SELECT source, lang, n_chars FROM documents").select(
        F.col("source").alias("wiki"),
        F.explode(F.create_map(
            F.lit("lang-code"), F.col("lang"),
            F.lit("type"), F.when(F.col("n_chars") % 2 == 0, "").otherwise("wiki"),
            F.lit("source"), F.when(F.col("lang") == "en", F.col("source")))).alias("key", "value"))
    return P.missing_keys(infos, "wiki")


@query(f"SELECT title, html FROM ({ARTICLES_SQL}) AS a")
def p11_project(spark, sf_dir):
    return convert_articles(wiki_pages(spark, sf_dir)).select("title", "html")


# --- joins -----------------------------------------------------------------

@query(over(WIKI_PAGES, "page_id, title, lang, concat('English ', lang) AS english, concat('Local ', lang) AS local"))
def j01_with_language(spark, sf_dir):
    names = view(spark, sf_dir, LANGUAGES)
    return J.with_language(wiki_pages(spark, sf_dir).select("page_id", "title", "lang"), names)


# Every chain ends: those of the pages, and a chain over all documents whose number is even.
CHAINS = ("SELECT concat('Chain ', cast(doc_id AS string)) AS title_from, concat('Chain ', cast(CASE WHEN doc_id % 50 = 48 "
          "THEN doc_id - 18 ELSE doc_id + 2 END AS string)) AS title_to FROM documents WHERE doc_id % 2 = 0 AND doc_id % 50 <> 28")
_JUMPS = (f"r AS (SELECT {REDIRECTS} FROM ({WIKI_PAGES}) AS w WHERE redirect_to <> '' UNION ALL {CHAINS}), "
          f"a AS (SELECT title FROM ({ROUTED}) AS q WHERE kind = 'article'), "
          "h AS (SELECT title_from AS start, title_to AS first, title_to AS target, CAST(1 AS BIGINT) AS hops FROM r UNION ALL "
          "SELECT start, first, r.title_to, hops + 1 FROM h JOIN r ON h.target = r.title_from WHERE hops < 60)")


@query(f"WITH RECURSIVE {_JUMPS}, e AS (SELECT start, first, max(hops) AS hops FROM h GROUP BY start, first) "
       "SELECT e.start AS title_from, e.first AS title_to, CASE WHEN e.hops < 60 THEN h.target END AS target, "
       "CASE WHEN e.hops < 60 THEN e.hops ELSE -1 END AS hops, e.hops < 60 AND h.target IN (SELECT title FROM a) AS found, "
       "e.hops >= 60 AS loops FROM e JOIN h ON e.start = h.start AND e.first = h.first AND e.hops = h.hops")
def j02_resolve_redirects(spark, sf_dir):
    """Chains of up to 23 redirects, and loops of ten."""
    redirects = _redirects(spark, sf_dir).unionByName(view(spark, sf_dir, CHAINS))
    return J.resolve_redirects(redirects, _articles(spark, sf_dir)).withColumn("hops", F.coalesce("hops", F.lit(-1).cast("long")))


LINK_SQL = r"\[\[([^\[\]|]*)(?:\|([^\[\]]*))?\]\](\w*)"


def _sql_items(source: str, items: str) -> str:
    return (f"SELECT page_id, i - 1 AS pos, l[i] AS item FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i "
            f"FROM (SELECT page_id, {items} AS l FROM ({source}) AS s) AS x) AS y")


def _sql_links(source: str) -> str:
    def group(n):
        return f"regexp_extract(item, {quote(LINK_SQL)}, {n})"
    label = f"CASE WHEN {group(2)} <> '' THEN {group(2)} ELSE {group(1)} END"
    prefix = f"CASE WHEN instr({group(1)}, ':') > 1 THEN split_part({group(1)}, ':', 1) ELSE '' END"
    items = _sql_items(source, f"regexp_extract_all(wikitext, {quote(LINK_SQL)})")
    return (f"SELECT page_id, cast(pos AS INTEGER) AS pos, {group(1)} AS target, {label} AS label, {group(3)} AS trail, "
            f"{prefix} AS namespace FROM ({items}) AS z")


def _links(spark, sf_dir):
    """Stored, since the joins read the links twice."""
    path = scratch(spark, "links")
    D.extract_links(wiki_pages(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


ARTICLE_TITLES = f"(SELECT title FROM ({ROUTED}) AS q WHERE kind = 'article')"


@query(f"WITH l AS ({_sql_links(WIKI_PAGES)}) SELECT *, target IN {ARTICLE_TITLES} AS exists FROM l")
def j03_links_to_articles(spark, sf_dir):
    return J.links_to_articles(_links(spark, sf_dir), _articles(spark, sf_dir))


@query(f"WITH l AS ({_sql_links(WIKI_PAGES)}) SELECT target, count(*) AS n_links FROM l "
       f"WHERE target NOT IN {ARTICLE_TITLES} GROUP BY target")
def j03_missing_articles(spark, sf_dir):
    return J.missing_articles(D.extract_links(wiki_pages(spark, sf_dir)), _articles(spark, sf_dir))


# --- counts, ids, shards ---------------------------------------------------

@query(over(WIKI_PAGES, "count(*) AS n"))
def a01_count_rows(spark, sf_dir):
    return A.count_rows(wiki_pages(spark, sf_dir))


BY_KIND = over(ROUTED, "kind, count(*) AS n", "WHERE kind <> 'dropped' GROUP BY kind")


@query(BY_KIND)
def a02_count_by_kind(spark, sf_dir):
    return A.count_by_kind(_routed(spark, sf_dir))


@query(BY_KIND)
def a03_reconcile(spark, sf_dir):
    """Rows announced while reading, checked against the rows stored."""
    path = scratch(spark, "reconciled")
    announced = write_wiki(wiki_pages(spark, sf_dir), path)
    return stored_counts(spark, path).where(
        F.col("n") == F.when(F.col("kind") == P.ARTICLE, announced.articles).otherwise(announced.redirects))


IDS = f"SELECT page_id, title, row_number() OVER (ORDER BY page_id) AS article_id FROM ({ROUTED}) AS r WHERE kind = 'article'"


@query(IDS)
def a04_assign_ids(spark, sf_dir):
    return A.assign_ids(_articles(spark, sf_dir).select("page_id", "title"))


@query("SELECT doc_id * 9000000000000 AS page_id, row_number() OVER (ORDER BY doc_id) AS article_id FROM documents")
def a04_sparse_ids(spark, sf_dir):
    """Ids far apart, as hashed ones are."""
    return A.assign_ids(view(spark, sf_dir, "SELECT doc_id * 9000000000000 AS page_id FROM documents"))


@query(over(IDS, f"page_id, title, article_id, (article_id - 1) // {MAX_ARTICLES} AS shard, "
            f"(article_id - 1) % {MAX_ARTICLES} + 1 AS shard_article_id"))
def a05_shard_ids(spark, sf_dir):
    return A.shard_ids(_articles(spark, sf_dir).select("page_id", "title"), MAX_ARTICLES)


@query(SHARDED + "SELECT shard, count(*) FILTER (WHERE kind = 'article') AS articles, "
       "count(*) FILTER (WHERE kind = 'redirect') AS redirects FROM s GROUP BY shard")
def a06_shard_counts(spark, sf_dir):
    return A.shard_counts(A.shard_emitted(_routed(spark, sf_dir), MAX_ARTICLES))


@query("SELECT lower(trim(item)) AS name, count(*) AS n FROM ("
       + _sql_items(WIKI_PAGES, r"regexp_extract_all(wikitext, '\{\{+([^{}|]*)', 1)") + ") AS z GROUP BY lower(trim(item))")
def a07_template_census(spark, sf_dir):
    return D.template_census(wiki_pages(spark, sf_dir))


@query(f"WITH l AS ({_sql_links(RICH_PAGES)}) SELECT target, count(*) AS n_links FROM l GROUP BY target")
def a08_link_counts(spark, sf_dir):
    return A.link_counts(D.extract_links(rich_pages(spark, sf_dir)))


# --- order -----------------------------------------------------------------

@query(over(WIKI_PAGES, PAGES, "ORDER BY page_id LIMIT 1"))
def o01_first_row(spark, sf_dir):
    return wiki_pages(spark, sf_dir).orderBy("page_id").limit(1)


@query(over(WIKI_PAGES, "page_id, title"))
def o02_order_by_title(spark, sf_dir):
    return wiki_pages(spark, sf_dir).select("page_id", "title").orderBy("title")


# --- title search ----------------------------------------------------------

INDEX_SQL = (f"SELECT DISTINCT unnest(regexp_extract_all(lower(title), '[a-z0-9]+')) AS token, article_id, title FROM ({IDS}) AS i")


def _index(spark, sf_dir):
    return X.title_index(A.assign_ids(_articles(spark, sf_dir).select("page_id", "title")))


@query(INDEX_SQL)
def x01_title_index(spark, sf_dir):
    path = scratch(spark, "title-index")
    K.write_title_index(_index(spark, sf_dir), path)
    return spark.read.parquet(path).select("token", "article_id", "title")


@query(f"WITH x AS ({INDEX_SQL}) SELECT article_id, title FROM x WHERE token = 'doc' OR token LIKE '1%' "
       "GROUP BY article_id, title HAVING bool_or(token = 'doc') AND bool_or(token LIKE '1%')")
def x02_search_titles(spark, sf_dir):
    """In the stored index; the terms are cut as titles are."""
    path = scratch(spark, "title-index")
    K.write_title_index(_index(spark, sf_dir), path)
    return X.search_titles(spark.read.parquet(path), "(Doc) 1*")


# --- side tables -----------------------------------------------------------

@query(_sql_links(RICH_PAGES))
def d01_extract_links(spark, sf_dir):
    return D.extract_links(rich_pages(spark, sf_dir))


_EXT = r"\[(\w[^ \n]*) ([^\]\n]*)\]"


@query("SELECT page_id, cast(pos AS INTEGER) AS pos, regexp_extract(item, " + quote(_EXT) + ", 1) AS url, regexp_extract(item, "
       + quote(_EXT) + ", 2) AS label FROM ("
       + _sql_items(RICH_PAGES, f"regexp_extract_all({replaced(sql_anchors('wikitext'), LEFTOVER)}, {quote(_EXT)})") + ") AS z")
def d02_extract_external_links(spark, sf_dir):
    return D.extract_external_links(rich_pages(spark, sf_dir))


@query(f"SELECT page_id, cast(pos AS INTEGER) AS pos, cast({LEVEL} AS INTEGER) AS level, {HEADING_TITLE} AS title "
       f"FROM ({sql_numbered(RICH_PAGES)}) AS n WHERE {IS_HEADING}")
def d03_extract_sections(spark, sf_dir):
    return D.extract_sections(rich_pages(spark, sf_dir))


@query("SELECT page_id, cast(pos AS INTEGER) AS pos, trim(split_part(item, '|', 1)) AS name, "
       "array_to_string(string_split(item, '|')[2:], '|') AS args FROM ("
       + _sql_items(WIKI_PAGES, r"regexp_extract_all(wikitext, '\{\{([^{}]*)\}\}', 1)") + ") AS z")
def d04_extract_templates(spark, sf_dir):
    return D.extract_templates(wiki_pages(spark, sf_dir)).withColumn("args", F.array_join("args", "|"))


@query("SELECT page_id, cast(pos + 1 AS INTEGER) AS index, item AS body FROM ("
       + _sql_items(RICH_PAGES, r"regexp_extract_all(wikitext, '(?is)<\s*code(?:\s*| [^>]+?)>.*?<\s*/\s*code\s*>')") + ") AS z")
def d05_extract_code_blocks(spark, sf_dir):
    return D.extract_code_blocks(rich_pages(spark, sf_dir))


# --- streaming -------------------------------------------------------------

@cache
def _ingested(application: str, sf_dir: str):
    """The dump ingested once as a stream: (where it is stored, metrics, titles)."""
    spark = SparkSession.active()
    path = scratch(spark, "ingested")
    metrics, titles = scratch(spark, "metrics"), scratch(spark, "titles")
    query = ingest(stream_pages(spark, wiki_dump(spark, sf_dir), files_per_batch=40), path, scratch(spark, "offsets"),
                   metrics=metrics, titles=titles)
    query.awaitTermination()
    return path, metrics, titles


@query(ARTICLES_SQL)
def g01_stream_articles(spark, sf_dir):
    path, _, _ = _ingested(spark.sparkContext.applicationId, sf_dir)
    return ingested(spark, path, P.ARTICLE)


@query(over(WIKI_PAGES, REDIRECTS, "WHERE redirect_to <> ''"))
def g01_stream_redirects(spark, sf_dir):
    path, _, _ = _ingested(spark.sparkContext.applicationId, sf_dir)
    return ingested(spark, path, P.REDIRECT)


@query("SELECT cast(count(*) AS BIGINT) AS pages, count(*) FILTER (WHERE doc_id % 10 = 0) AS redirects FROM documents")
def g02_run_metrics(spark, sf_dir):
    """Counts stored by the batches of the stream."""
    _, metrics, _ = _ingested(spark.sparkContext.applicationId, sf_dir)
    return run_metrics(spark, metrics).agg(F.sum("pages").alias("pages"), F.sum("redirects").alias("redirects"))


@query(f"SELECT count(*) AS articles, cast(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS ids, "
       f"cast(0 AS BIGINT) AS out_of_range FROM ({IDS}) AS i")
def a04_ids_by_batch(spark, sf_dir):
    """Ids that go on from batch to batch of a stream: dense, none twice, none out of its batch's range."""
    _, _, titles = _ingested(spark.sparkContext.applicationId, sf_dir)
    rows = growing_titles(spark, titles)
    ranges = id_ranges(spark, titles)
    outside = rows.join(F.broadcast(ranges), F.col("article_id").between(F.col("first"), F.col("last")), "left_anti")
    return rows.agg(F.count("*").alias("articles"), F.min("article_id").alias("first_id"), F.max("article_id").alias("last_id"),
                    F.count_distinct("article_id").alias("ids")).join(outside.agg(F.count("*").alias("out_of_range")))  # one row


@query(f"WITH x AS ({INDEX_SQL.replace('article_id', 'page_id')}) SELECT page_id, title FROM x WHERE token = 'doc' OR token LIKE '1%' "
       "GROUP BY page_id, title HAVING bool_or(token = 'doc') AND bool_or(token LIKE '1%')")
def x02_search_batches(spark, sf_dir):
    """In the index that the batches of a stream left, after it was compacted."""
    _, _, titles = _ingested(spark.sparkContext.applicationId, sf_dir)
    compact_index(spark, titles)
    found = X.search_titles(growing_index(spark, titles), "(Doc) 1*")
    return found.join(growing_titles(spark, titles), ["article_id", "title"]).select("page_id", "title")


_WIKIS = f"SELECT * REPLACE (CASE WHEN {IS_WIKTIONARY} THEN 'wiktionary' ELSE lang END AS lang) FROM ({WIKI_PAGES}) AS v"


@cache
def _ingested_dumps(application: str, sf_dir: str):
    """A folder of dumps of several wikis, some pages of which cannot be parsed."""
    spark = SparkSession.active()
    path, metrics = scratch(spark, "wikis"), scratch(spark, "metrics")
    ingest_dumps(spark, whole_dumps(spark, sf_dir), path, scratch(spark, "offsets"), metrics=metrics, files_per_batch=3).awaitTermination()
    return path, metrics


@query(f"SELECT * FROM ({ARTICLES_SQL.replace(WIKI_PAGES, _WIKIS)}) AS a WHERE page_id % 7 <> 0")
def g01_two_wikis(spark, sf_dir):
    """A wikipedia and a wiktionary of one language in a stream, told apart by their headers."""
    path, _ = _ingested_dumps(spark.sparkContext.applicationId, sf_dir)
    return ingested(spark, path, P.ARTICLE)


@query("SELECT doc_id AS page_id FROM documents WHERE doc_id % 7 = 0")
def g01_broken(spark, sf_dir):
    """The records that the stream set aside while it went on."""
    path, _ = _ingested_dumps(spark.sparkContext.applicationId, sf_dir)
    return quarantined(spark, path).select(F.regexp_extract("broken", r"<id>(\d+)</id>", 1).cast("long").alias("page_id"))


@query(f"WITH r AS ({ROUTED.replace(WIKI_PAGES, _WIKIS)}), k AS (SELECT count(*) AS pages, "
       "count(*) FILTER (WHERE kind = 'article' AND page_id % 7 <> 0) AS articles, "
       "count(*) FILTER (WHERE kind = 'redirect' AND page_id % 7 <> 0) AS redirects, "
       "count(*) FILTER (WHERE page_id % 7 = 0) AS broken FROM r) SELECT * FROM k")
def a03_reconcile_batches(spark, sf_dir):
    """Rows stored by the batches, each compared with what it announced."""
    _, metrics = _ingested_dumps(spark.sparkContext.applicationId, sf_dir)
    return run_metrics(spark, metrics).agg(*(F.sum(c).alias(c) for c in ("pages", "articles", "redirects", "broken")))
