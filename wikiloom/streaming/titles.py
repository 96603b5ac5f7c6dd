"""Article ids and a title index that grow batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.operators.counts import assign_ids
from wikiloom.operators.search import title_index
from wikiloom.shared import finished
from wikiloom.sinks.tables import write_by_title, write_title_index

TITLES = "article_id long, page_id long, title string, batch long"
INDEX = "token string, article_id long, title string, initial string"
RANGES = "first long, last long, batch long"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The finished batches of a table; none where nothing was stored yet."""
    folders = [f"{path}/{name}" for name in finished(spark, path)]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], schema)


def id_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``first, last, batch``: the ids that each batch has, ``last`` below ``first`` if it has none."""
    return _table(spark, f"{path}/ranges", RANGES)


def add_titles(articles: DataFrame, path: str, batch_id: int) -> None:
    """Give the ``page_id, title`` of a batch their ids, and add them to the titles and the index at ``path``.

    The ids are dense and in page order within a batch; they go on after the
    last id of the batches before, which are known by one row each. A batch
    that runs again overwrites its own folders and gives the same ids. Its row
    of ``ranges`` comes last, and a batch without it is not read.
    """
    spark = articles.sparkSession
    last = id_ranges(spark, path).where(F.col("batch") < batch_id).agg(F.coalesce(F.max("last"), F.lit(0))).first()[0]
    titles = f"{path}/titles/batch={batch_id}"
    numbered = assign_ids(articles.select("page_id", "title")).withColumn("article_id", F.col("article_id") + last)
    write_by_title(numbered.select("article_id", "page_id", "title"), titles)
    stored = spark.read.schema("article_id long, page_id long, title string").parquet(titles)
    write_title_index(title_index(stored), f"{path}/index/batch={batch_id}")
    count = stored.count()
    spark.range(1).select(F.lit(last + 1).cast("long").alias("first"), F.lit(last + count).cast("long").alias("last")).write.mode(
        "overwrite").parquet(f"{path}/ranges/batch={batch_id}")


def _complete(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    return rows.join(F.broadcast(id_ranges(spark, path).select("batch")), "batch", "left_semi")  # a row per batch


def growing_titles(spark: SparkSession, path: str) -> DataFrame:
    """``article_id, page_id, title`` of all batches."""
    return _complete(_table(spark, f"{path}/titles", TITLES), spark, path).drop("batch")


def _generation(spark: SparkSession, path: str) -> int:
    """The last batch that is in the compacted index; -1 if there is none."""
    return max((int(name.split("=")[1]) for name in finished(spark, f"{path}/compacted")), default=-1)


def growing_index(spark: SparkSession, path: str) -> DataFrame:
    """``token, article_id, title, initial``: the compacted index and the batches since."""
    upto = _generation(spark, path)
    since = _table(spark, f"{path}/index", f"{INDEX}, batch long").where(F.col("batch") > upto)
    since = _complete(since, spark, path).select("token", "article_id", "title", "initial")
    if upto < 0:
        return since
    return spark.read.schema(INDEX).parquet(f"{path}/compacted/upto={upto}").unionByName(since)


def compact_index(spark: SparkSession, path: str) -> int:
    """Rewrite the index of all batches as one, a folder per initial, sorted by token; returns its last batch.

    The new generation is read as soon as it is finished. Older folders stay,
    so a search that runs meanwhile goes on. Run it between batches.
    """
    upto = id_ranges(spark, path).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
    if upto > _generation(spark, path):
        write_title_index(growing_index(spark, path).drop("initial"), f"{path}/compacted/upto={upto}")
    return upto
