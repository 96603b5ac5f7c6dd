"""Routing, joins, counts, sources, sinks, streaming."""

import bz2
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from wikiloom.operators import counts as A
from wikiloom.operators import lookups as J
from wikiloom.operators import routing as P
from wikiloom.operators import search as X
from wikiloom.plans.convert import (CountMismatch, RunCounts, convert_dump, reconcile, show_articles, stored_articles,
                                    stored_redirects, stored_titles, write_wiki)
from wikiloom.sinks import tables as K
from wikiloom.sources import dump as S
from wikiloom.sources.tables import page_directory, read_metadata
from wikiloom.streaming.ingest import RunMetrics, ingest, ingested, run_metrics, stream_pages

PAGE_SCHEMA = "page_id long, title string, redirect_to string, lang string, wikitext string"
PAGES = [
    (1, "Vieux fours", "Fours anciens", "fr", "#REDIRECT"),
    (2, "Argile (roche)", None, "fr", "{{Voir|Argile}}\n'''Argile'''"),
    (3, "Modèle:X", None, "fr", "body"),
    (4, "Catégorie:Y", "Catégorie:Z", "fr", "#REDIRECT"),
    (5, "Race:Pot", None, "fr", "cuit "),
    (6, "Leer", None, "de", None),
    (7, "Empty", None, "en", ""),
    (8, ":odd", "", "en", "kept"),
    (9, "Category:C", None, "en", "dropped"),
    (10, "Category:C", None, "fr", "kept in French"),
]
KINDS = ["redirect", "article", "dropped", "redirect", "article", "dropped", "dropped", "article", "dropped", "article"]

HEADER = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="fr">
  <siteinfo>
    <sitename>Kilnpedia</sitename>
    <dbname>kilnwiki</dbname>
    <base>https://kiln.test/wiki/Start</base>
    <generator>MediaWiki 1.41</generator>
    <namespaces><namespace key="-2">Média</namespace></namespaces>
  </siteinfo>
"""


def page_xml(page_id, title, redirect, text):
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
    target = f'\n    <redirect title="{esc(redirect)}" />' if redirect else ""
    body = "" if text is None else f'\n      <text xml:space="preserve">{esc(text)}</text>'
    return (f"  <page>\n    <title>{esc(title)}</title>\n    <ns>0</ns>\n    <id>{page_id}</id>{target}\n    <revision>\n"
            f"      <id>{page_id * 7}</id>\n      <contributor><id>3</id></contributor>{body}\n    </revision>\n  </page>\n")


def dump_xml(pages=PAGES):
    return HEADER + "".join(page_xml(i, t, r, w) for i, t, r, _, w in pages) + "</mediawiki>\n"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, PAGE_SCHEMA)


@pytest.fixture(scope="module")
def languages(spark):
    return spark.createDataFrame([("FR", "French", "Français"), ("en", "English", "English")],
                                 "code string, english string, local string")


# --- routing ---------------------------------------------------------------

def test_route(pages):
    rows = P.route_pages(pages).orderBy("page_id").collect()
    assert [r.kind for r in rows] == KINDS
    assert {(r.title_from, r.title_to) for r in P.redirects(pages).collect()} == {
        ("Vieux fours", "Fours anciens"), ("Catégorie:Y", "Catégorie:Z")}
    assert {r.kind: r.n for r in A.count_by_kind(P.route_pages(pages)).collect()} == {"article": 4, "redirect": 2}


def test_lookups(pages):
    assert [r.page_id for r in P.lookup_title(pages, "Category:C").collect()] == [9]
    assert P.lookup_title(pages, "none").count() == 0
    assert [r.title for r in P.lookup_id(pages, 5).collect()] == ["Race:Pot"]
    assert {r.page_id for r in P.select_titles(pages, "Race:Pot,Nope,Category:C").collect()} == {5, 9, 10}
    assert [r.title for r in P.missing_titles(pages, ["Race:Pot", "Nope"]).collect()] == ["Nope"]
    assert show_articles(pages, "Race:Pot", convert=False).collect() == [("Race:Pot", "cuit ")]
    assert show_articles(pages, "Argile (roche)").collect() == [("Argile (roche)", "<br/><br/><b>Argile</b>")]


def test_metadata_keys(spark, tmp_path):
    infos = {"lang-code": "fr", "lang-local": "l", "lang-english": "e", "type": "t", "source": "s", "author": "a",
             "dbname": "not kept"}
    with pytest.raises(ValueError, match="author, .*|source"):
        P.require_keys({**infos, "source": ""})
    K.write_metadata(spark, infos, str(tmp_path / "m"))
    stored = read_metadata(spark, str(tmp_path / "m"))
    assert stored.pop("date") and stored.pop("version") == "2.5"
    assert stored == {k: v for k, v in infos.items() if k != "dbname"}


# --- joins -----------------------------------------------------------------

def test_join_on_key_with_hot_key(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 40)}") for i in range(3000)] + [(-1, None), (-2, "gone")]
    keyed = [("hot", 1, "H")] + [(f"k{i}", i, None if i % 3 else "v") for i in range(0, 40, 2)]
    monkeypatch.setattr(J, "HOT_ROWS", 50)
    left = spark.createDataFrame(rows, "i int, k string")
    right = spark.createDataFrame(keyed, "k string, n int, v string")
    got = {tuple(r) for r in J.join_on_key(left, right, "k").collect()}
    table = {k: (n, v) for k, n, v in keyed}
    assert got == {(i, k, *table.get(k, (None, None))) for i, k in rows}
    assert J.join_on_key(left, right, "k").count() == len(rows) and J.hot_keys(left, "k")[0] == "hot"


def test_with_language(pages, languages):
    got = {r.page_id: (r.english, r.local) for r in J.with_language(pages, languages).collect()}
    assert got[1] == ("French", "Français") and got[6] == (None, None) and got[7] == ("English", "English")
    assert len(got) == len(PAGES)


def test_resolve_redirects(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "Page"), ("x", "y"), ("y", "x"), ("d", "nowhere"), ("e", "Page"), ("s", "s")]
    redirects = spark.createDataFrame(pairs, "title_from string, title_to string")
    articles = spark.createDataFrame([("Page",), ("Page",)], "title string")
    got = {r.title_from: (r.target, r.hops, r.found, r.loops) for r in J.resolve_redirects(redirects, articles).collect()}
    assert got == {"a": ("Page", 3, True, False), "b": ("Page", 2, True, False), "c": ("Page", 1, True, False),
                   "e": ("Page", 1, True, False), "d": ("nowhere", 1, False, False), "x": (None, None, False, True),
                   "y": (None, None, False, True), "s": (None, None, False, True)}


def test_long_chains_and_loops(spark):
    rng = random.Random(11)
    follow = {i: rng.randint(0, 399) if i % 60 == 59 else i + 1 for i in range(300)}
    redirects = spark.createDataFrame([(f"t{i}", f"t{j}") for i, j in follow.items()], "title_from string, title_to string")
    articles = spark.createDataFrame([("t300",), ("t310",)], "title string")

    def expected(i):
        target, hops = follow[i], 1
        while target in follow and hops < 1000:
            target, hops = follow[target], hops + 1
        return (None, None, False, True) if hops == 1000 else (f"t{target}", hops, target in (300, 310), False)

    got = {r.title_from: (r.target, r.hops, r.found, r.loops) for r in J.resolve_redirects(redirects, articles).collect()}
    assert got == {f"t{i}": expected(i) for i in follow}
    empty = J.resolve_redirects(redirects.limit(0), articles)
    assert empty.count() == 0 and empty.columns == ["title_from", "title_to", "target", "hops", "found", "loops"]


# --- ids and shards --------------------------------------------------------

def test_running_ids(spark):
    rng = random.Random(5)
    ids = rng.sample(range(-500, 100000), 2000)
    df = spark.createDataFrame([(i, rng.random() < 0.5) for i in ids], "page_id long, f boolean")
    got = A.running_count(df, F.col("f"), "n", width=1000).orderBy("page_id").collect()
    total = 0
    for row in got:
        total += row.f
        assert row.n == total
    dense = [r.article_id for r in A.assign_ids(df).orderBy("page_id").collect()]
    assert dense == list(range(1, 2001))
    hashed = spark.createDataFrame([(i * 90_000_000_000_000,) for i in ids], "page_id long")
    assert [r.article_id for r in A.assign_ids(hashed).orderBy("page_id").collect()] == dense
    with pytest.raises(Exception, match="occurs twice"):
        A.assign_ids(hashed.unionByName(hashed.limit(1))).collect()
    assert A.assign_ids(hashed.limit(0)).count() == 0
    for n in (1, 2, 7, 1999, 2500):
        parts = [r.part for r in A.split_table(df, n).orderBy("page_id").collect()]
        size, rest = divmod(2000, n)
        assert parts == [p + 1 for p in range(n) for _ in range(size + (p < rest))]


@pytest.mark.parametrize("articles,k", [(10, 3), (9, 3), (1, 5), (0, 4)])
def test_shards(spark, tmp_path, articles, k):
    kinds = ["article"] * articles + ["redirect"] * 7
    random.Random(articles).shuffle(kinds)
    routed = spark.createDataFrame([(i, f"t{i}", kind) for i, kind in enumerate(kinds)] + [(99, "x", "dropped")],
                                   "page_id long, title string, kind string")
    sharded = A.shard_emitted(routed, k)
    seen, expected = 0, {}
    for i, kind in enumerate(kinds):
        seen += kind == "article"
        expected[i] = min((seen - (kind == "article")) // k, max((articles - 1) // k, 0))
    assert {r.page_id: r.shard for r in sharded.collect()} == expected
    K.write_sharded(sharded, str(tmp_path / "s"))
    counts = {r.shard: (r.articles, r.redirects) for r in A.shard_counts(spark.read.parquet(str(tmp_path / "s"))).collect()}
    assert all(a <= k for a, _ in counts.values()) and sum(a for a, _ in counts.values()) == articles
    assert sum(r for _, r in counts.values()) == 7


# --- search ----------------------------------------------------------------

def test_search(spark):
    titles = [(1, "Été à PARIS, 1900"), (2, "Paris-Match"), (3, "Pari"), (4, "!!!")]
    index = X.title_index(spark.createDataFrame(titles, "article_id long, title string"))
    assert {(r.token, r.article_id) for r in index.collect()} == {
        ("Été", 1), ("à", 1), ("paris", 1), ("1900", 1), ("paris", 2), ("match", 2), ("pari", 3)}

    def search(query):
        return {r.article_id for r in X.search_titles(index, query).collect()}

    assert search("PARIS") == {1, 2}
    assert search("pari*") == {1, 2, 3}
    assert search("paris 19*") == {1}
    assert search("paris missing") == set()


# --- sources ---------------------------------------------------------------

def test_dump(spark, tmp_path, languages):
    path = tmp_path / "dump.xml"
    path.write_text(dump_xml(), encoding="utf-8")
    (tmp_path / "dump.xml.gz").write_bytes(gzip.compress(path.read_bytes()))
    (tmp_path / "dump.xml.bz2").write_bytes(bz2.compress(path.read_bytes()))
    expected = [(i, t, r or None, w or None) for i, t, r, _, w in PAGES]
    for name in ("dump.xml", "dump.xml.gz", "dump.xml.bz2"):
        df = S.read_pages(spark, str(tmp_path / name), "fr").orderBy("page_id")
        assert [(r.page_id, r.title, r.redirect_to, r.wikitext or None) for r in df.collect()] == expected
    info = S.read_siteinfo(spark, str(path), languages, author="me")
    assert info == {
        "lang": "fr", "generator": "MediaWiki 1.41", "sitename": "Kilnpedia", "dbname": "kilnwiki",
        "base": "https://kiln.test/wiki/Start", "lang-code": "fr",
        "lang-local": "Français", "lang-english": "French", "type": "Kilnpedia", "author": "me",
        "source": "https://kiln.test/wiki/Start"}
    other = tmp_path / "other.xml"
    other.write_text("<html></html>")
    with pytest.raises(ValueError, match="not a MediaWiki dump"):
        S.read_siteinfo(spark, str(other))


def test_one_dump_is_read_in_parallel(spark, tmp_path):
    pages = [(i, f"T{i}", None, "fr", f"é{i} " * 2000 + "\n") for i in range(300)]
    path = tmp_path / "big.xml"
    path.write_text(dump_xml(pages), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        df = S.read_pages(spark, str(path))
        assert df.rdd.getNumPartitions() > 8
        assert {(r.page_id, r.wikitext) for r in df.collect()} == {(p[0], p[4]) for p in pages}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# --- sinks -----------------------------------------------------------------

def test_write_wiki(spark, pages, tmp_path):
    counts = write_wiki(pages, str(tmp_path / "w"))
    assert counts == RunCounts(articles=4, redirects=2)
    assert {r.title for r in stored_articles(spark, str(tmp_path / "w")).collect()} == {
        "Argile (roche)", "Race:Pot", ":odd", "Category:C"}
    assert stored_redirects(spark, str(tmp_path / "w")).count() == 2
    with pytest.raises(CountMismatch):
        reconcile(counts, RunCounts(4, 1))


def test_convert_dump(spark, tmp_path):
    """Language and wiki type come from the header; rules and French namespaces are for wikipedias only."""
    text = dump_xml([*PAGES, (11, "Heure", None, "fr", "{{heure|8}}")])
    for name, base, titles in (
            ("other", "https://kiln.test/wiki/Start", ["Argile (roche)", "Modèle:X", "Race:Pot", ":odd", "Heure"]),
            ("pedia", "https://fr.wikipedia.org/wiki/Start", ["Argile (roche)", "Race:Pot", ":odd", "Category:C", "Category:C", "Heure"])):
        path, out = str(tmp_path / f"{name}.xml"), str(tmp_path / name)
        with open(path, "w", encoding="utf-8") as file:
            file.write(text.replace("https://kiln.test/wiki/Start", base))
        assert convert_dump(spark, path, out) == RunCounts(len(titles), 2)
        rows = stored_titles(spark, out).orderBy("article_id").collect()
        assert [r.title for r in rows] == titles and [r.article_id for r in rows] == list(range(1, len(titles) + 1))
        html = {r.title: r.html for r in stored_articles(spark, out).collect()}
        assert html["Heure"] == ("8 h" if name == "pedia" else "<br/><br/>")  # a line without text is a break
        found = X.search_titles(spark.read.parquet(f"{out}/index"), "argile (roche)").collect()
        assert [r.title for r in found] == ["Argile (roche)"]
        assert read_metadata(spark, f"{out}/metadata")["lang-code"] == "fr"
        with pytest.raises(Exception, match="(?i)exists"):
            convert_dump(spark, path, out)


def test_layouts(spark, pages, tmp_path):
    import pyarrow.parquet as pq

    K.write_by_title(pages, str(tmp_path / "t"))
    files = [os.path.join(tmp_path / "t", f) for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")]
    for file in files:
        titles = pq.read_table(file, columns=["title"])["title"].to_pylist()
        assert titles == sorted(titles)
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    scan = spark.read.parquet(str(tmp_path / "t")).where(F.col("title") == "Leer")
    assert "EqualTo(title,Leer)" in scan._jdf.queryExecution().executedPlan().toString()

    for name in ("left_titles", "right_titles"):
        K.write_bucketed(pages, name, 4, path=str(tmp_path / name))
    joined = spark.table("left_titles").hint("merge").join(spark.table("right_titles"), "title")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    for name in ("left_titles", "right_titles"):
        spark.sql(f"DROP TABLE {name}")

    K.write_articles(pages.select("page_id", "title", F.lit("h").alias("html")), str(tmp_path / "a"))
    directory = page_directory(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert {r.ns for r in directory} == {"", "Modèle", "Catégorie", "Race", "Category"}
    assert all(r.input_file.endswith(".parquet") for r in directory)


# --- streaming -------------------------------------------------------------

def test_stream(spark, tmp_path):
    inbox, out, offsets, metrics = (str(tmp_path / n) for n in ("in", "out", "offsets", "metrics"))
    os.mkdir(inbox)
    listener = RunMetrics()
    spark.streams.addListener(listener)
    try:
        for part, chunk in enumerate((PAGES[:5], PAGES[5:])):
            with open(f"{inbox}/{part}.xml", "w", encoding="utf-8") as file:
                file.write(dump_xml(chunk))
            query = ingest(stream_pages(spark, inbox, "fr"), out, offsets, metrics=metrics)
            query.awaitTermination()
        assert [(r.batch, r.pages, r.redirects) for r in run_metrics(spark, metrics).orderBy("batch").collect()] == [
            (0, 5, 2), (1, 5, 0)]
    finally:
        spark.streams.removeListener(listener)
    assert {r.title for r in ingested(spark, out, "article").collect()} == {
        "Argile (roche)", "Race:Pot", ":odd", "Category:C"}
    assert ingested(spark, out, "redirect").count() == 2


# --- narrow plans ----------------------------------------------------------

def test_conversion_needs_no_shuffle_and_no_python(spark, pages, tmp_path):
    from wikiloom.plans.convert import convert_articles

    pages.write.parquet(str(tmp_path / "p"))
    plan = convert_articles(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan



@pytest.mark.parametrize("fault", ["&bogus; <", "&#1;", "</text></revision></wrong>"])
def test_broken_pages_are_not_lost(spark, tmp_path, fault):
    good = dump_xml()
    bad = page_xml(77, "Scherbe", None, "XXX").replace("XXX", fault)
    (tmp_path / "dump.xml").write_text(good.replace("</mediawiki>", bad + "</mediawiki>"))
    with pytest.raises(Exception, match="cannot be parsed"):
        S.read_pages(spark, str(tmp_path), "fr").collect()
    kept = S.read_pages(spark, str(tmp_path), "fr", on_broken="skip").collect()
    assert sorted(r.page_id for r in kept) == [p[0] for p in PAGES]
    assert [("Scherbe" in r.raw) for r in S.broken_pages(spark, str(tmp_path)).collect()] == [True]


def test_dump_that_was_cut_off(spark, tmp_path):
    whole = dump_xml()
    (tmp_path / "dump.xml").write_text(whole[:whole.rindex("<revision>") + 20])
    with pytest.raises(Exception, match="cannot be parsed"):
        S.read_pages(spark, str(tmp_path), "fr").collect()


def test_search_cuts_terms_as_titles(spark):
    articles = spark.createDataFrame([(1, "Foo-Bar"), (2, "Foo Ton"), (3, "Tonne")], "article_id long, title string")
    index = X.title_index(articles)
    for query, ids in (("foo-bar", {1}), ("(foo)", {1, 2}), ("ton*", {2, 3}), ("foo ton*", {2})):
        assert {r.article_id for r in X.search_titles(index, query).collect()} == ids


def test_redirect_rounds_follow_the_longest_chain(spark, monkeypatch):
    """Chains, tails and loops against a walk; the rounds do not grow with the number of titles."""
    import random

    from wikiloom.operators import lookups

    rng, jumps = random.Random(5), {}
    for c in range(300):  # chains of up to 20, half of them into a loop of up to 12
        length, loop = rng.randint(1, 20), rng.randint(1, 12) if c % 2 else 0
        names = [f"{rng.random():.9f}-{c}-{i}" for i in range(length + loop)]
        for a, b in zip(names, names[1:]):
            jumps[a] = b
        if loop:
            jumps[names[-1]] = names[length]
        else:
            jumps[names[-1]] = "End" if c % 4 else "Nowhere"
    jumps["Self"] = "Self"

    def walk(title):
        seen, hops = {title}, 0
        while title in jumps:
            title, hops = jumps[title], hops + 1
            if title in seen:
                return None, None, False, True
            seen.add(title)
        return title, hops, title == "End", False

    names, plain = [], lookups.stored
    monkeypatch.setattr(lookups, "stored", lambda df, name: names.append(name) or plain(df, name))
    got = lookups.resolve_redirects(spark.createDataFrame(list(jumps.items()), "title_from string, title_to string"),
                                    spark.createDataFrame([("End",)], "title string")).collect()
    assert sorted(tuple(r) for r in got if not r.loops) == sorted((a, b, *walk(a)) for a, b in jumps.items() if not walk(a)[3])
    assert sorted(r.title_from for r in got if r.loops) == sorted(a for a in jumps if walk(a)[3])
    assert len(jumps) > 3000 and names.count("hops") <= 2 + 2 * 7


def exchanges(df):
    """The shuffles of a plan, as formatted nodes."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_sharded_pages_move_once(spark):
    from wikiloom.plans.convert import emitted_rows, stored_shards, write_wiki
    from wikiloom.shared import new_path

    rows = [(i * 3, f"T{i}", "Other" if i % 5 == 0 else None, "en", f"text {i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, title string, redirect_to string, lang string, wikitext string").repartition(3)
    stored_pages = new_path(spark, "pages")
    pages.write.parquet(stored_pages)
    emitted = emitted_rows(spark.read.parquet(stored_pages), max_articles=30)
    assert len([e for e in exchanges(emitted) if "hashpartitioning(_part" in e or "wikitext" in e or "rangepartitioning" in e]) == 1
    assert sum("SinglePartition" not in e for e in exchanges(emitted)) == 1
    path = new_path(spark, "wiki")
    counts = write_wiki(pages, path, max_articles=30)
    got = stored_shards(spark, path).collect()
    articles = sorted((r for r in got if r.kind == "article"), key=lambda r: r.page_id)
    assert (counts.articles, counts.redirects) == (160, 40) == (len(articles), len(got) - len(articles))
    assert [(r.shard, r.shard_article_id) for r in articles] == [(i // 30, i % 30 + 1) for i in range(160)]


def test_skipped_pages_are_counted(spark, tmp_path):
    from wikiloom.plans.convert import convert_dump

    page = "<page><title>T%d</title><ns>0</ns><id>%d</id><revision><id>1</id><text>text</text></revision></page>"
    broken = "<page><title>B</title><ns>0</ns><id>9</id><revision><text>&bogus; <</text></revision></page>"
    head = ('<mediawiki xml:lang="en"><siteinfo><sitename>W</sitename><dbname>w</dbname>'
            '<base>https://en.wikipedia.org/wiki/Main</base><generator>g</generator></siteinfo>')
    (tmp_path / "dump.xml").write_text(head + "\n" + page % (1, 1) + "\n" + broken + "\n" + page % (2, 2) + "\n</mediawiki>")
    counts = convert_dump(spark, str(tmp_path / "dump.xml"), str(tmp_path / "out"), on_broken="skip")
    assert (counts.articles, counts.redirects, counts.broken) == (2, 0, 1)
    assert "<title>B</title>" in spark.read.parquet(str(tmp_path / "out/broken")).first().raw


PAGE = "<page><title>%s</title><ns>0</ns><id>%d</id><revision><id>1</id><text>%s</text></revision></page>"
HEAD = ('<mediawiki xml:lang="%s"><siteinfo><sitename>W</sitename><dbname>w</dbname>'
        '<base>https://%s.%s.org/wiki/Main</base><generator>g</generator></siteinfo>')


def test_places_over_many_splits(spark, tmp_path):
    from wikiloom.sources.dump import read_pages
    from wikiloom.sources.places import fetch_pages, page_places

    for name in ("a.xml", "b.xml"):
        pages = [PAGE % (f"{name} é&amp;{i}", i, "ö " * (i % 97)) for i in range(400)]
        (tmp_path / name).write_text(HEAD % ("en", "en", "wikipedia") + "\n" + "\n  ".join(pages) + "\n</mediawiki>", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        places = page_places(spark, str(tmp_path)).cache()
        assert places.rdd.getNumPartitions() > 1
        rows = places.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for row in rows:
        data = (tmp_path / row.file.rsplit("/", 1)[1]).read_bytes()[row.offset:row.offset + row.length].decode()
        assert data.startswith("<page>") and data.endswith("</page>") and f"<id>{row.page_id}</id>" in data
    assert len(rows) == 800 and {r.title for r in rows if r.page_id == 7} == {"a.xml é&7", "b.xml é&7"}
    order = ["title", "page_id"]
    columns = ["page_id", "title", "ns", "redirect_to", "revision_id", "wikitext"]
    want = read_pages(spark, str(tmp_path)).select(columns).orderBy(order).collect()
    assert fetch_pages(places).select(columns).orderBy(order).collect() == want
    with pytest.raises(Exception, match="no page at byte"):
        fetch_pages(places.withColumn("offset", places["offset"] + 1)).collect()


def test_bucketed_join_moves_nothing(spark):
    from catalog.tables import QUERIES

    joined = QUERIES["k06_bucketed_join"](spark, "/root/testdata/sf0.001")
    joined.collect()
    assert exchanges(joined) == [] and "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_stream_goes_on_and_compares_counts(spark, tmp_path, monkeypatch):
    from wikiloom.streaming import ingest as I

    folder = tmp_path / "dumps"
    folder.mkdir()

    def run():
        I.ingest_dumps(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "offsets"), metrics=str(tmp_path / "metrics")).awaitTermination()

    template = "{{1er mai}} x"
    (folder / "fr.xml").write_text(HEAD % ("fr", "fr", "wikipedia") + PAGE % ("Un", 1, template) + PAGE % ("Modèle:x", 2, "y")
                                   + "<page><title>Cut</title><id>3</id><revision><text>no end", encoding="utf-8")
    run()
    (folder / "wikt.xml").write_text(HEAD % ("fr", "fr", "wiktionary") + PAGE % ("Deux", 4, template) + PAGE % ("Modèle:y", 5, "y"), encoding="utf-8")
    full = I.convert_routed
    monkeypatch.setattr(I, "convert_routed", lambda *args: full(*args).where("title <> 'Deux'"))
    with pytest.raises(Exception, match="announced"):
        run()
    monkeypatch.undo()
    run()
    got = {r.title: r.html for r in I.ingested(spark, str(tmp_path / "out"), "article").collect()}
    assert got == {"Un": "1<sup>er</sup> mai x", "Deux": " x", "Modèle:y": "y"}  # the wiktionary has neither the rules nor the namespaces
    assert [r.broken[:19] for r in I.quarantined(spark, str(tmp_path / "out")).collect()] == ["<page><title>Cut</t"]
    totals = I.run_metrics(spark, str(tmp_path / "metrics")).groupBy().sum("pages", "articles", "broken").first()
    assert tuple(totals) == (5, 3, 1)


def test_titles_grow_by_batch(spark, tmp_path):
    from wikiloom.streaming import titles as G

    path = str(tmp_path / "titles")
    batches = [[(7, "Foo Bar"), (3, "Bar-Ton")], [], [(5, "Foo Ton"), (9, "Été bar"), (1, "Tonne")]]
    frames = [spark.createDataFrame(rows, "page_id long, title string") for rows in batches]
    whole = X.title_index(spark.createDataFrame([(i, t) for i, t in ((1, "Bar-Ton"), (2, "Foo Bar"), (3, "Tonne"), (4, "Foo Ton"), (5, "Été bar"))],
                                                "article_id long, title string"))

    def state():
        index = G.growing_index(spark, path)
        return ({tuple(r) for r in G.growing_titles(spark, path).collect()}, sorted(map(tuple, index.select("token", "article_id").collect())),
                [{tuple(r) for r in X.search_titles(index, q).collect()} for q in ("foo", "ton*", "bar", "foo-ton", "été")])

    assert state() == (set(), [], [set()] * 5) and G.compact_index(spark, path) == -1
    for number, frame in enumerate(frames):
        G.add_titles(frame, path, number)
        if number == 1:
            assert G.compact_index(spark, path) == 1
    once = state()
    assert once[0] == {(1, 3, "Bar-Ton"), (2, 7, "Foo Bar"), (3, 1, "Tonne"), (4, 5, "Foo Ton"), (5, 9, "Été bar")}
    assert once[1] == sorted(map(tuple, whole.select("token", "article_id").collect()))
    assert once[2] == [{tuple(r) for r in X.search_titles(whole, q).collect()} for q in ("foo", "ton*", "bar", "foo-ton", "été")]
    G.add_titles(frames[2], path, 2)  # the batch runs again
    assert state() == once
    assert G.compact_index(spark, path) == 2 and state() == once
    plan = G.growing_index(spark, path).where("initial = 'f'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(initial" in plan
    (tmp_path / "titles" / "ranges" / "batch=2" / "_SUCCESS").unlink()  # a batch that did not come to its end
    assert {r.page_id for r in G.growing_titles(spark, path).collect()} == {3, 7}
