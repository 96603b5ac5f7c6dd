"""The place of each page in plain dumps, and pages fetched by place."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wikiloom.sources.dump import PAGE_END, parse_pages, xml_plain

_START = "<page>"
#: Bytes that a fetching task gets, about.
TASK_BYTES = 64 << 20


def page_places(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, length, page_id, title`` of each page of plain dumps, in bytes.

    Folders of a partitioned path are further columns. Tasks read splits of a
    file and do not know how far the task before them read on to the end of its
    last page; so bytes are summed inside each split, and then over the splits
    of a file. No window sees more than the pages of a split, without text.
    """
    records = spark.read.text(path, lineSep=PAGE_END)
    others = [c for c in records.columns if c != "value"]
    before = F.octet_length(F.substring_index("value", _START, 1)).cast("long")
    size = F.octet_length("value").cast("long") + len(PAGE_END)
    head = F.substring_index("value", "<revision>", 1)
    rows = records.select(
        *others, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"), before.alias("_before"), size.alias("_size"),
        F.contains("value", F.lit(_START)).alias("_is_page"),
        F.regexp_extract(head, r"<id>(\d+)</id>", 1).try_cast("long").alias("page_id"),
        xml_plain(F.regexp_extract(head, r"<title>([^<]*)</title>", 1)).alias("title"))
    splits = rows.groupBy("file", "_split").agg(F.sum("_size").alias("_bytes"))
    upto = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_bytes").over(upto), F.lit(0))).drop("_bytes")
    inside = Window.partitionBy("file", "_split").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_upto", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(starts, ["file", "_split"])
    return placed.where("_is_page").select(
        *others, "file", (F.col("_start") + F.col("_upto") + F.col("_before")).alias("offset"),
        (F.col("_size") - F.col("_before")).alias("length"), "page_id", "title")


def fetch_records(places: DataFrame) -> DataFrame:
    """``value``, the text of the page, for each row of ``file, offset, length``; further columns stay.

    The number of tasks follows from the bytes asked for. Bytes that are no
    page, as after a dump was changed, raise an error.
    """
    others = [c for c in places.columns if c not in ("offset", "length", "value")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened, file = None, None
        for batch in batches:
            texts = []
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if name != opened:
                    store, path = fs.FileSystem.from_uri(name)
                    opened, file = name, store.open_input_file(path)
                data = file.read_at(length, offset)
                if not data.startswith(_START.encode()) or not data.endswith(PAGE_END.encode()):
                    raise ValueError(f"{name}: no page at byte {offset}")
                texts.append(data[:-len(PAGE_END)].decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(texts, pa.string())], [*others, "value"])

    wanted = places.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    part = F.floor(F.col("offset") / TASK_BYTES)
    dealt = places.repartition(-(-wanted // TASK_BYTES) or 1, "file", part).sortWithinPartitions("file", "offset")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in places.schema if f.name in others]
    return dealt.mapInArrow(run, ", ".join([*fields, "value string"]))


def fetch_pages(places: DataFrame, on_broken: str = "raise") -> DataFrame:
    """The pages at the given places, as ``read_pages`` gives them."""
    return parse_pages(fetch_records(places.drop("page_id", "title")).drop("file"), on_broken)
