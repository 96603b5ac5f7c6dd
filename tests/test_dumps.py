"""The dumps that the stream queries read: rows of their own, in many files."""

import pytest

from tests.test_tables import exchanges

N = 400


@pytest.fixture()
def folder(spark, tmp_path):
    rows = spark.range(1, N + 1).selectExpr("id AS doc_id", "concat('Some words ', repeat('x', 100)) AS text",
                                            "CASE WHEN id % 4 = 0 THEN 'fr' ELSE 'en' END AS lang", "'s' AS source", "111L AS n_chars")
    rows.repartition(8, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(1).selectExpr("id AS page_id", "'u' AS url", "'h' AS html").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def files(path):
    from glob import glob

    return {name: open(name, encoding="utf-8").read() for name in glob(f"{path.removeprefix('file:')}/*/part-*")}


def test_large_wikis_are_dumped_in_parts(spark, folder, monkeypatch):
    from catalog import tables, views

    monkeypatch.setattr(views, "DUMP_CHARS", 20_000)
    texts = files(views.whole_dumps(spark, folder))
    assert all(text.startswith("<mediawiki ") and text.count("<siteinfo>") == 1 for text in texts.values())
    assert sum(text.count("<page>") for text in texts.values()) == N
    english = [text for name, text in texts.items() if "wiki=enwikipedia" in name]
    assert len(english) >= 5 and max(map(len, english)) < sum(map(len, english)) / 3
    counts = tables.a03_reconcile_batches(spark, folder).first()
    assert (counts.pages, counts.broken) == (N, N // 7)
    assert {row.page_id for row in tables.g01_broken(spark, folder).collect()} == set(range(7, N + 1, 7))


def test_dump_is_written_by_the_tasks_that_read(spark, folder):
    from catalog import views

    assert exchanges(views.wiki_pages(spark, folder, enough=0)) == [] != exchanges(views.wiki_pages(spark, folder))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    texts = files(views.wiki_dump(spark, folder))
    assert sum(text.count("<page>") for text in texts.values()) == N
    assert len([text for text in texts.values() if "<page>" in text]) <= 2 * 4  # two languages, a task per core
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
