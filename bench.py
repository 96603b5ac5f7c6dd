"""Times the headline queries on the tables in $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import text, tables, views  # noqa: E402
from wikiloom.operators import routing  # noqa: E402
from wikiloom.plans.convert import convert_dump, write_wiki  # noqa: E402
from wikiloom.sources import dump  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = [
    "t42_convert_articles", "t42_convert_rich", "t15_unescape_entities", "t20_drop_elements", "t40_compact",
    "f20_translate_by_template", "p01_route_pages", "d01_extract_links", "d04_extract_templates",
    "a07_template_census", "a08_link_counts", "a05_shard_ids", "j02_resolve_redirects", "j03_links_to_articles",
    "x02_search_titles", "k06_write_by_title",
]


def consume(df: DataFrame) -> None:
    """Compute all rows and columns, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = text.QUERIES | tables.QUERIES
    for name in ("t42_convert_articles", "f20_translate_by_template"):  # warm the JVM
        consume(queries[name](spark, SF_DIR))

    path = views.wiki_dump(spark, SF_DIR)
    dump_bytes = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)
    n_articles = queries["p01_route_pages"](spark, SF_DIR).where(F.col("kind") == routing.ARTICLE).count()

    def dump_to_wiki() -> None:
        write_wiki(dump.spread(dump.read_pages(spark, path), "page_id"), views.scratch(spark, "bench"))

    largest, n_whole = max(queries["p01_route_pages"](spark, SF_DIR).where(F.col("kind") == routing.ARTICLE)
                           .join(views.wiki_pages(spark, SF_DIR).select("page_id", "lang"), "page_id")
                           .groupBy("lang").count().collect(), key=lambda row: row["count"])

    def whole_conversion() -> None:
        """One wiki with all that belongs to it: pages, ids, title layout, title index, metadata."""
        convert_dump(spark, f"{path}/lang={largest}", views.scratch(spark, "bench"))

    seconds = {"dump_to_wiki": timed(dump_to_wiki), "convert_dump": timed(whole_conversion)}
    for name in HEADLINE:
        seconds[name] = timed(lambda: consume(queries[name](spark, SF_DIR)))
    rate = n_articles / seconds["dump_to_wiki"]
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "articles": n_articles,
        "articles_per_second": round(rate, 1),
        "convert_dump_articles": n_whole,
        "convert_dump_articles_per_second": round(n_whole / seconds["convert_dump"], 1),
        "articles_per_second_per_core": round(rate / CPUS, 1),
        "dump_mb_per_second": round(dump_bytes / 1e6 / seconds["dump_to_wiki"], 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
