"""Parquet outputs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.config import METADATA_VERSION
from wikiloom.operators.routing import require_keys

# Codec of the html column's files.
COMPRESSION = "zstd"
# Rows per file at most, so that no file grows with its shard.
ROWS_PER_FILE = 1_000_000


def _write(df: DataFrame, path: str, mode: str, *partition_by: str) -> None:
    writer = df.write.mode(mode).option("compression", COMPRESSION).option("maxRecordsPerFile", ROWS_PER_FILE)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_articles(articles: DataFrame, path: str, mode: str = "append") -> None:
    """Keeps ``article_id`` or ``page_id`` next to title and html."""
    ids = [c for c in ("article_id", "page_id") if c in articles.columns]
    _write(articles.select(*ids, "title", "html"), path, mode)


def write_redirects(redirects: DataFrame, path: str, mode: str = "append") -> None:
    _write(redirects.select("title_from", "title_to"), path, mode)


def metadata_rows(infos: Mapping[str, str], generated: datetime | None = None) -> list[tuple[str, str]]:
    """The kept keys, each once, with generation date and version."""
    require_keys(infos)
    generated = generated or datetime.now(timezone.utc)
    return [
        ("lang-code", infos["lang-code"]), ("lang-local", infos["lang-local"]),
        ("lang-english", infos["lang-english"]), ("date", generated.strftime("%Y-%m-%d %H:%M:%S")),
        ("version", METADATA_VERSION), ("source", infos["source"]), ("author", infos["author"]),
        ("type", infos["type"]),
    ]


def write_metadata(spark: SparkSession, infos: Mapping[str, str], path: str,
                   generated: datetime | None = None) -> None:
    rows = [(key, value, i) for i, (key, value) in enumerate(metadata_rows(infos, generated))]
    table = spark.createDataFrame(rows, "key string, value string, position int")
    table.coalesce(1).write.mode("overwrite").parquet(path)


def write_sharded(sharded: DataFrame, path: str, order: str = "page_id", mode: str = "overwrite", by: str = "shard") -> None:
    """One folder per ``shard``, or per ``part`` of a split table.

    The range partitioning keeps a shard's rows together and still splits a
    shard that is too large for one task.
    """
    _write(sharded.repartitionByRange(by, order), path, mode, by)


def write_by_title(df: DataFrame, path: str, key: str = "title", mode: str = "overwrite") -> None:
    """Sorted by title, so that a lookup skips all files and row groups but a few."""
    _write(df.repartitionByRange(key).sortWithinPartitions(key), path, mode)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "title", mode: str = "overwrite",
                   path: str | None = None) -> None:
    """Catalog table bucketed by title: joins on the title need no shuffle."""
    writer = df.write.mode(mode).option("compression", COMPRESSION).bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def write_title_index(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Folders by the token's first letter or digit, sorted by token inside.

    The article id in the range key splits tokens that most titles share.
    """
    first = F.left("token", F.lit(1))
    initial = F.when(F.rlike(first, F.lit("[0-9a-z]")), first).otherwise("other")
    ordered = (index.withColumn("initial", initial)
               .repartitionByRange("initial", "token", "article_id")
               .sortWithinPartitions("initial", "token"))
    _write(ordered, path, mode, "initial")
