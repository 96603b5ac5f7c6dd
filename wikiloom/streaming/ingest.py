"""Incremental ingest of dump files with Structured Streaming."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wikiloom.config import Languages, Options
from wikiloom.operators.routing import ARTICLE, BROKEN, REDIRECT, guess_wikitype, route_pages
from wikiloom.plans.convert import RunCounts, convert_routed, html_columns, reconcile
from wikiloom.sinks.tables import COMPRESSION
from wikiloom.sources.dump import PAGE_END, parse_pages, site_rows
from wikiloom.streaming.titles import add_titles


def _counts() -> list[Column]:
    """What is counted over the pages of a batch."""
    return [F.count("*").alias("pages"),
            F.count_if(F.coalesce(F.col("redirect_to") != "", F.lit(False))).alias("redirects"),
            F.coalesce(F.sum(F.length("wikitext")), F.lit(0)).alias("characters")]


def _records(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    return spark.readStream.option("lineSep", PAGE_END).option("maxFilesPerTrigger", files_per_batch).text(folder)


def stream_pages(spark: SparkSession, folder: str, lang: str | None = None,
                 files_per_batch: int = 100, on_broken: str = "raise") -> DataFrame:
    """Pages of all dump files in a folder, present and future.

    ``lang`` may be left out for a folder with ``lang=…`` folders inside. A
    page that cannot be parsed stops the stream, at every restart; with
    ``on_broken="keep"`` it is a row that ``ingest`` sets aside.
    """
    pages = parse_pages(_records(spark, folder, files_per_batch), on_broken)
    return pages.withColumn("lang", F.lit(lang)) if lang is not None else pages


def _store(pages: DataFrame, batch_id: int, path: str, options: Options, languages: Languages | None,
           wikitype: Column | None, metrics: str | None, titles: str | None, columns: list[Column]) -> None:
    """Write one batch, broken records in a folder of their own, and compare the counts.

    A batch whose stored rows differ from those announced fails, so the stream
    stops before the batch counts as done, and runs it again when restarted.
    """
    seen = Observation()
    kinds = [F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in (ARTICLE, REDIRECT, BROKEN)]
    routed = route_pages(pages, languages, wikitype).observe(seen, *_counts(), *kinds)
    folder, spark = f"{path}/batch={batch_id}", pages.sparkSession
    rows = convert_routed(routed, options, languages, wikitype, None, columns)
    rows.write.mode("overwrite").option("compression", COMPRESSION).partitionBy("kind").parquet(folder)
    found = spark.read.schema(rows.schema).parquet(folder).groupBy("kind").count()  # a schema, since a batch may be empty
    written = {row["kind"]: row["count"] for row in found.collect()}
    announced = seen.get
    counts = [RunCounts(*(n.get(prefix + kind, 0) for kind in (ARTICLE, REDIRECT, BROKEN)))
              for n, prefix in ((announced, "n_"), (written, ""))]
    reconcile(*counts)
    if titles is not None:
        add_titles(spark.read.schema(rows.schema).parquet(folder).where(F.col("kind") == ARTICLE), titles, batch_id)
    if metrics is not None:
        values = {name: n for name, n in announced.items() if not name.startswith("n_")} | asdict(counts[1])
        row = [F.lit(n).cast("long").alias(name) for name, n in values.items()]
        spark.range(1).select(*row).write.mode("overwrite").parquet(f"{metrics}/batch={batch_id}")


def _started(stream: DataFrame, store, checkpoint: str, keep_running: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer if keep_running else writer.trigger(availableNow=True)).start()


def ingest(pages: DataFrame, path: str, checkpoint: str, options: Options = Options(),
           languages: Languages | None = None, keep_running: bool = False, wikitype: Column | None = None,
           metrics: str | None = None, titles: str | None = None) -> StreamingQuery:
    """Convert a page stream into ``path/batch=…/kind=…``.

    A batch that is run again overwrites its own folder, so pages are stored
    once even after a failure; its rows are counted on the way in and must be
    stored in that number. Broken records that the stream keeps are stored too,
    see ``quarantined``. By default the query stops when it has read what is
    there. With ``metrics``, a folder of its own, each batch stores its counts
    there as ``batch=…``; read them with ``run_metrics``. With ``titles``, another
    folder, articles get ids that go on from batch to batch, and their titles an
    index; page ids must then be unique. Read them with ``growing_titles`` and
    ``growing_index``.
    """
    counted, columns = pages.observe("pages", *_counts()), html_columns(options, languages, wikitype)
    return _started(counted, lambda batch, batch_id: _store(batch, batch_id, path, options, languages, wikitype, metrics, titles, columns),
                    checkpoint, keep_running)


def ingest_dumps(spark: SparkSession, folder: str, path: str, checkpoint: str, options: Options = Options(),
                 languages: Languages | None = None, keep_running: bool = False, metrics: str | None = None,
                 files_per_batch: int = 100, titles: str | None = None) -> StreamingQuery:
    """Convert all dumps that come into a folder, each by the language and wiki type of its own header.

    Otherwise like ``ingest``; records that cannot be parsed are set aside. A
    file is in one batch as a whole, so its header is found there: a table of
    one row per file of the batch, ``files_per_batch`` at most. Pages of a file
    without header have no language and no wiki type.
    """
    records = _records(spark, folder, files_per_batch).select("value", F.col("_metadata.file_path").alias("file"))
    columns = html_columns(options, languages, F.col("wikitype"))

    def store(batch: DataFrame, batch_id: int) -> None:
        heads = site_rows(batch).groupBy("file").agg(F.first("lang").alias("lang"), guess_wikitype(F.first("base")).alias("wikitype"))
        pages = parse_pages(batch, "keep").join(F.broadcast(heads), "file", "left")
        _store(pages, batch_id, path, options, languages, F.col("wikitype"), metrics, titles, columns)

    return _started(records, store, checkpoint, keep_running)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """``batch, broken``: the records of all batches that could not be parsed."""
    return _stored(spark, path).where(F.col("kind") == BROKEN).select("batch", "broken")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    # Batches without broken records may lack the column.
    return spark.read.option("mergeSchema", "true").parquet(path)


def ingested(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Stored articles or redirects of all batches."""
    rows = _stored(spark, path).where(F.col("kind") == kind)
    if kind == REDIRECT:
        return rows.select(F.col("title").alias("title_from"), "title_to")
    assert kind == ARTICLE
    return rows.select("page_id", "title", "html")


def _progress(progress) -> dict:
    observed = progress.observedMetrics.get("pages")
    return {
        "batch": progress.batchId,
        "records": progress.numInputRows,
        "records_per_second": progress.processedRowsPerSecond,
        **(observed.asDict() if observed is not None else {}),
    }


class RunMetrics(StreamingQueryListener):
    """Collects the counts of each batch: register with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.batches: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches.append(_progress(event.progress))

    def onQueryTerminated(self, event) -> None:
        pass


def run_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """``batch, pages, characters, articles, redirects, broken`` of all batches ever run.

    The counts by kind are those of the stored rows.
    """
    return spark.read.option("basePath", metrics).parquet(metrics)
