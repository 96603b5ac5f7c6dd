"""What a stream does once, and what it does per batch."""

import re

from pyspark.sql import functions as F

HEAD = '<mediawiki xml:lang="en">\n  <siteinfo><sitename>W</sitename><base>https://en.wikipedia.org/wiki/Main</base></siteinfo>'
PAGE = "\n  <page><title>%s</title><id>%d</id><revision><text>%s</text></revision></page>"


def test_steps_are_built_once_for_all_batches(spark, tmp_path, monkeypatch):
    from wikiloom.plans import convert as C
    from wikiloom.streaming import ingest as I

    built, full = [], C.convert_steps
    monkeypatch.setattr(C, "convert_steps", lambda *args: built.append(1) or full(*args))
    (tmp_path / "dumps").mkdir()
    for i in range(3):
        (tmp_path / "dumps" / f"{i}.xml").write_text(HEAD + PAGE % (f"Page {i}", i, f"'''bold {i}'''"), encoding="utf-8")
    I.ingest_dumps(spark, str(tmp_path / "dumps"), str(tmp_path / "out"), str(tmp_path / "offsets"), files_per_batch=1).awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) == 3 and len(built) == 1
    assert {r.title: r.html for r in I.ingested(spark, str(tmp_path / "out"), "article").collect()} == {
        f"Page {i}": f"<b>bold {i}</b>" for i in range(3)}


def test_tags_apart_and_unclosed(spark):
    from wikiloom.functions import markup as M

    plain = "words without any markup " * 400
    cases = [f"{plain}<!-- a - b -->{plain}<br/><ref name=x/>{plain}<div class=c>{plain}</div>", "a<!--b-->c<!--d", "<br", "a<br>b/c<br/>",
             "<div", "x<div y", "< / div>z", "<brx/><divx>", "<!-->", "<code>a</code>b<code>c</code><code>a</code>", "<code>a<code>b</code>", "<code"]

    def got(step):
        rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", step(F.col("t")).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]

    assert got(M.drop_comments) == [re.sub(r"<!--(?:[^-]|-(?!->))*-->", "", t, flags=re.S) for t in cases]
    assert got(M.drop_self_closing)[1:5] == ["a<!--b-->c<!--d", "<br", "a<br>b/c", "<div"]
    assert got(M.unwrap_ignored_tags)[4:8] == ["<div", "x<div y", "z", "<brx/><divx>"]
    assert got(M.placeholders)[-3:] == ["codice_1bcodice_2codice_1", "codice_1", "<code"]
    assert got(M.drop_self_closing)[0].count("<br/>") == 0 and got(M.unwrap_ignored_tags)[0].count("div") == 0
