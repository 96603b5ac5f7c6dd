"""Counts, dense ids and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikiloom.operators.routing import ARTICLE, REDIRECT
from wikiloom.shared import stored

# Rows per bucket at most: ids are unique, a bucket spans this many of them.
BUCKET_WIDTH = 65_536
# The same where rows are whole pages, and articles that a task gets.
SHARD_BUCKET, PER_TASK = 8_192, 50_000


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def count_by_kind(routed: DataFrame) -> DataFrame:
    """Emitted redirects and articles."""
    return (routed.where(F.col("kind").isin(REDIRECT, ARTICLE))
            .groupBy("kind").agg(F.count("*").alias("n")))


def link_counts(links: DataFrame) -> DataFrame:
    return links.groupBy("target").agg(F.count("*").alias("n_links"))


def bucket_starts(buckets: DataFrame, width: int, levels: int) -> DataFrame:
    """``_bucket, _start``: the sum of ``_n`` over all smaller buckets.

    Buckets are summed in wider ones, ``levels`` times, so that each window
    sees ``width`` rows at most, however sparse the ids are.
    """
    if levels == 0:
        before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        return buckets.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    wide = buckets.withColumn("_wide", F.expr(f"(_bucket - pmod(_bucket, {width}L)) div {width}L"))
    above = bucket_starts(wide.groupBy(F.col("_wide").alias("_bucket")).agg(F.sum("_n").alias("_n")), width, levels - 1)
    before = Window.partitionBy("_wide").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (wide.join(above.select(F.col("_bucket").alias("_wide"), F.col("_start").alias("_above")), "_wide")
            .select("_bucket", (F.col("_above") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_start")))


def running_count(df: DataFrame, flag: Column, name: str, order: str = "page_id",
                  width: int = BUCKET_WIDTH, per_task: int | None = None) -> DataFrame:
    """Adds the number of flagged rows up to each row in the order of unique ids.

    Rows are counted per bucket of neighbouring ids, buckets in wider buckets,
    and so on until few are left; windows inside a bucket give the rest. No
    window sees more than ``width`` rows, also where ids are sparse or hashed,
    and ids come out the same however often a task is run again. How many
    levels are needed follows from the least and the largest id. An id that
    occurs twice raises an error, since its order would change between runs.

    With ``per_task`` the counts of the buckets are stored, and a task gets
    neighbouring buckets with about that many flagged rows. Then rows move once,
    in the order that is wanted for writing, as wide tables need.
    """
    least, most = df.agg(F.min(order), F.max(order)).first()
    span, levels = (max(abs(least), abs(most)) // width if least is not None else 0), 0
    while span >= width // 2:
        span, levels = span // width, levels + 1
    bucketed = df.withColumn("_bucket", F.expr(f"({order} - pmod({order}, {width}L)) div {width}L")).withColumn(
        "_flag", F.when(flag, 1).otherwise(0).cast("long"))
    starts = bucket_starts(bucketed.groupBy("_bucket").agg(F.sum("_flag").alias("_n")), width, levels)
    part = F.lit(0) if per_task is None else F.floor(F.col("_start") / per_task)
    if per_task is not None:
        starts = stored(starts, "starts")
    joined = bucketed.join(starts, "_bucket").withColumn("_part", part)
    if per_task is not None:
        joined = joined.repartition("_part")
    inside = Window.partitionBy(*(["_bucket"] if per_task is None else ["_part", "_bucket"])).orderBy(order)
    upto = F.sum("_flag").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    once = F.when(F.lag(order).over(inside) == F.col(order), F.raise_error(
        F.concat(F.lit(f"{order} occurs twice: "), F.col(order).cast("string"))).cast("long")).otherwise(upto)
    return joined.withColumn(name, F.col("_start") + once).drop("_bucket", "_flag", "_start", "_part")


def assign_ids(articles: DataFrame, order: str = "page_id", name: str = "article_id") -> DataFrame:
    """Dense ids 1..n in page order."""
    return running_count(articles, F.lit(True), name, order)


def shard_ids(articles: DataFrame, max_articles: int) -> DataFrame:
    """Adds ``article_id``, ``shard`` and ``shard_article_id``, which restarts per shard."""
    position = F.col("article_id") - 1
    return (assign_ids(articles)
            .withColumn("shard", F.floor(position / max_articles))
            .withColumn("shard_article_id", position % max_articles + 1))


def shard_emitted(routed: DataFrame, max_articles: int) -> DataFrame:
    """Adds ``shard`` to articles and redirects together, and ``shard_article_id`` to articles.

    A redirect goes to the shard that is open at its place in page order; the
    last shard stays open until the end. Ids restart in every shard. The rows
    move once and come out in page order within tasks, so hand over pages
    before they are converted and write the result as it is.
    """
    is_article = F.col("kind") == ARTICLE
    emitted = running_count(routed.where(F.col("kind").isin(REDIRECT, ARTICLE)), is_article, "_seen",
                            width=SHARD_BUCKET, per_task=PER_TASK)
    last = routed.where(is_article).agg(
        F.greatest(F.floor((F.count("*") - 1) / max_articles), F.lit(0)).alias("_last"))
    place = F.col("_seen") - 1
    return (emitted.join(F.broadcast(last))  # one row
            .withColumn("shard", F.least(F.floor(F.when(is_article, place).otherwise(F.col("_seen")) / max_articles), F.col("_last")))
            .withColumn("shard_article_id", F.when(is_article, place % max_articles + 1))
            .drop("_seen", "_last"))


def shard_counts(sharded: DataFrame) -> DataFrame:
    """Articles and redirects per shard."""
    return sharded.groupBy("shard").agg(
        F.count_if(F.col("kind") == ARTICLE).alias("articles"),
        F.count_if(F.col("kind") == REDIRECT).alias("redirects"))


def split_table(df: DataFrame, n: int = 2, order: str = "page_id") -> DataFrame:
    """Adds ``part`` 1..n of equal size in page order; the first ones take the rest."""
    total = df.agg(F.count("*").alias("_total"))
    size, rest = F.floor(F.col("_total") / n), F.col("_total") % n
    place = F.col("_place")
    return (running_count(df, F.lit(True), "_place", order).join(F.broadcast(total))  # one row
            .withColumn("part", F.when(place <= rest * (size + 1), F.floor((place - 1) / (size + 1)) + 1)
                        .otherwise(rest + F.floor((place - rest * (size + 1) - 1) / F.greatest(size, F.lit(1))) + 1))
            .drop("_place", "_total"))
