"""Joins by title and by language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.shared import stored

# Keys with more than HOT_ROWS rows are hot. The HOT_SHARE most frequent of them
# are split: every other key has less than 1/HOT_SHARE of all rows.
HOT_SHARE = 1000
HOT_ROWS = 100_000
#: Parts that a hot key's rows are split into.
PARTS = 200


def hot_keys(rows: DataFrame, key: str) -> list:
    """The hot values of ``key``, at most ``HOT_SHARE``; one job over that column."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    hot = counts.where(F.col("_n") > HOT_ROWS).orderBy(F.desc("_n"), key).limit(HOT_SHARE)
    return [row[0] for row in hot.select(key).collect()]


def join_on_key(rows: DataFrame, keyed: DataFrame, key: str, n_rows: int | None = None) -> DataFrame:
    """Left join of ``rows`` with a table that has one row per ``key``.

    With ``n_rows``, the number of rows or more, no hot key is looked for where
    there can be none.

    The rows of a hot key are dealt over ``PARTS`` salts, and its partner is
    repeated for each of them; all other rows have one salt. Hot keys are found
    beforehand from the key column, so hand over a stored table where ``rows``
    is costly to compute. The plan reads both sides once.
    """
    hot = hot_keys(rows, key) if n_rows is None or n_rows > HOT_ROWS else []
    if not hot:
        return rows.join(keyed, key, "left").select(*rows.columns, *(c for c in keyed.columns if c != key))
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    zero = F.lit(0).cast("long")
    salt = F.when(is_hot, F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS))).otherwise(zero)
    salts = F.when(is_hot, F.sequence(zero, F.lit(PARTS - 1).cast("long"))).otherwise(F.array(zero))
    salted = keyed.withColumn("_salt", F.explode(salts))
    return rows.withColumn("_salt", salt).join(salted, [key, "_salt"], "left").select(
        *rows.columns, *(c for c in keyed.columns if c != key))


def with_language(pages: DataFrame, languages: DataFrame) -> DataFrame:
    """Adds ``english`` and ``local`` names of the page's language.

    ``languages(code, english, local)``: the code is matched without regard to
    case and the first row in order of the names counts.
    """
    names = languages.groupBy(F.lower("code").alias("_code")).agg(
        F.min(F.struct("english", "local")).alias("_names"))
    return (pages.join(names, F.lower("lang") == F.col("_code"), "left")
            .withColumn("english", F.col("_names.english"))
            .withColumn("local", F.col("_names.local"))
            .drop("_code", "_names"))


def resolve_redirects(redirects: DataFrame, articles: DataFrame) -> DataFrame:
    """Follow ``title_from -> title_to`` to the end of each chain.

    Returns ``title_from, title_to, target, hops, found, loops``: ``target`` is
    the last title of the chain, ``found`` whether it is an article. A chain
    that runs into a loop has no end: ``target`` and ``hops`` are null and
    ``loops`` is true. A title that occurs twice leads to its first target in
    alphabetical order.

    Each round finishes the open jumps that lead to a jump that has just ended,
    and joins the others with themselves, so they double. A jump also has the
    smallest title it passes. On a chain, a jump and the one after it pass
    different titles, so equal smallest titles tell a loop, once jumps are as
    long as the loop. Rounds grow with the logarithm of the longest chain or
    loop; each stores two tables, of open jumps only.
    """
    jump = ["node", "target", "hops", "least"]
    first = stored(redirects.where("title_from is not null and title_to is not null")
                   .groupBy(F.col("title_from").alias("node"))
                   .agg(F.min("title_to").alias("target"), F.lit(1).cast("long").alias("hops"), F.min("title_to").alias("least")), "hops")
    onward = first.select(F.col("node").alias("target"), F.lit(True).alias("_onward"))
    split = stored(join_on_key(first, onward, "target", first.count()), "hops")
    fresh = split.where("_onward is null").select("node", "target", "hops", F.lit(False).alias("loops"))
    ended, open_ = fresh, split.where("_onward").select(jump)
    while n_open := open_.count():
        ends = fresh.select(F.col("node").alias("target"), F.col("target").alias("_end"), F.col("hops").alias("_hops"), F.col("loops").alias("_loops"))
        met = stored(join_on_key(open_, ends, "target", n_open), "hops")
        rest = met.where("_loops is null").select(jump)
        after = rest.select(F.col("node").alias("target"), F.col("target").alias("_next"), F.col("hops").alias("_hops"), F.col("least").alias("_least"))
        moved = stored(join_on_key(rest, after, "target", n_open), "hops")
        fresh = met.where("_loops is not null").select(
            "node", F.col("_end").alias("target"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_loops").alias("loops")).unionByName(
            moved.where("_least = least").select("node", F.lit(None).cast("string").alias("target"), F.lit(None).cast("long").alias("hops"),
                                                 F.lit(True).alias("loops")))
        ended = ended.unionByName(fresh)
        # A jump whose partner has just ended waits for the next round.
        open_ = moved.where("_least is null or _least <> least").select(
            "node", F.coalesce("_next", "target").alias("target"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            F.least("least", "_least").alias("least"))

    at_end = F.col("loops").isNull()  # title_to is no redirect itself
    goals = stored(redirects.select(F.col("title_to").alias("node")).distinct().join(ended, "node", "left").select(
        F.col("node").alias("title_to"), F.when(at_end, F.col("node")).otherwise(F.col("target")).alias("target"),
        F.when(at_end, 1).otherwise(F.col("hops") + 1).cast("long").alias("hops"),
        F.coalesce("loops", F.lit(False)).alias("loops")), "goals")
    titles = articles.select(F.col("title").alias("target")).distinct().withColumn("_found", F.lit(True))
    found = stored(join_on_key(goals, titles, "target").select(
        "title_to", "target", "hops", F.coalesce("_found", F.lit(False)).alias("found"), "loops"), "goals")
    return join_on_key(redirects.select("title_from", "title_to"), found, "title_to")


def links_to_articles(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Adds ``exists``: whether the link's target is an article title."""
    titles = articles.select(F.col("title").alias("target")).distinct().withColumn("_exists", F.lit(True))
    return (join_on_key(links, titles, "target")
            .withColumn("exists", F.coalesce("_exists", F.lit(False))).drop("_exists"))


def missing_articles(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Distinct link targets without an article, with the number of links.

    Counted per target before the join, so both sides have unique keys.
    """
    targets = links.groupBy("target").agg(F.count("*").alias("n_links"))
    return targets.join(articles.select(F.col("title").alias("target")).distinct(), "target", "left_anti")
