"""Tables derived from stored pages and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def page_directory(pages: DataFrame) -> DataFrame:
    """``page_id, title, ns, n_chars, input_file``: where each page is.

    ``ns`` is the title's prefix; select it from a file source, so that
    ``input_file`` is known.
    """
    return pages.select(
        "page_id", "title",
        F.when(F.instr("title", ":") > 1, F.substring_index("title", ":", 1)).otherwise("").alias("ns"),
        F.coalesce(F.length("wikitext"), F.lit(0)).alias("n_chars"),
        F.input_file_name().alias("input_file"))


def read_metadata(spark: SparkSession, path: str) -> dict[str, str]:
    """The metadata table as a map; a dozen rows, one per key."""
    return {row["key"]: row["value"] for row in unique_metadata(spark.read.parquet(path)).collect()}


def unique_metadata(table: DataFrame) -> DataFrame:
    """One row per key; of several the last one written counts."""
    if "position" not in table.columns:
        table = table.withColumn("position", F.lit(0))
    return table.groupBy("key").agg(F.max_by("value", F.struct("position", "value")).alias("value"))
