"""The whole conversion: expected articles, one column or many steps alike."""

from pyspark.sql import functions as F

from wikiloom.config import Language, Options, standard_languages
from wikiloom.functions.convert import convert, convert_steps
from wikiloom.functions.expr import apply_steps

PAGES = [
    ("fur",
     "[[File:oven.png|thumb]] A '''kiln''' ([[Oven|hot oven]]s {{audio|x.ogg|say}}) is ''old''.",
     ' A <b>kiln</b> (<a href="Oven">hot ovens</a> ) is <i>old</i> .'),
    ("fr",
     "un [[four|grand four]], ''[[Argile]]'' et [[pot]]s",
     'un <a href="four">grand four</a>, <i><a href="Argile">Argile</a></i> et <a href="pot">pots</a>'),
    ("fr",
     "{{Voir|A}}\nné le {{date|1|mai|2001}} [[Catégorie:X]][[Category:Y]]\n\n== Vie ==\n:* Nord\n"
     "{| class=w\n| a {{x}}\n|}\n<ref>r</ref>&amp;nbsp;&lt;b>fin\n\n\n\nbout <math>x</math>",
     '<br/><br/>né le 1er mai 2001 <a href="Category:Y">Category:Y</a><br/><br/><h2>Vie</h2>:* Nord<br/><br/>\xa0<b>fin'
     "<br/><br/>bout \\(x\\)"),
]


def test_expected_articles(spark):
    df = spark.createDataFrame([(lang, text) for lang, text, _ in PAGES], "lang string, text string")
    expected = [html for _, _, html in PAGES]
    as_column = [r.html for r in df.select(convert(F.col("text"), F.col("lang")).alias("html")).collect()]
    assert as_column == expected
    as_steps = [r.text for r in apply_steps(df, "text", convert_steps(F.col("lang"))).collect()]
    assert as_steps == expected


def test_options(spark):
    df = spark.createDataFrame([("fr", "{{1er mai}} [[a|b]]\n== t ==\n* x\n** y\n\nz")], "lang string, text string")

    def run(options, **kwargs):
        return df.select(convert(F.col("text"), F.col("lang"), options=options, **kwargs).alias("h")).first().h

    assert run(Options()) == '1<sup>er</sup> mai <a href="a">b</a><h2>t</h2>* x** y<br/><br/>z'
    assert run(Options(keep_links=False, keep_sections=False)) == "1<sup>er</sup> mai b* x** y<br/><br/>z"
    assert run(Options(lists="html", use_language_rules=False)) == (
        ' <a href="a">b</a><h2>t</h2><ul><li> x</li><ul><li> y</li></ul></ul><br/><br/>z')
    assert run(Options(), wikitype=F.lit("wiktionary")).startswith(' <a href="a">b</a>')


def test_language_plugin(spark):
    """A further language, with one rule as an Arrow UDF."""
    import pandas as pd

    @F.pandas_udf("string")
    def shout(s: pd.Series) -> pd.Series:
        return s.str.replace("{{laut}}", "LAUT", regex=False)

    languages = standard_languages().register(Language("de", ("Datei",), (shout,)))
    df = spark.createDataFrame([("de", "{{laut}} [[Datei:x]]y [[File:z]]"), ("en", "{{laut}} [[Datei:x]] [[File:z]]")],
                               "lang string, text string")
    got = [r.text for r in apply_steps(df, "text", convert_steps(F.col("lang"), languages=languages)).collect()]
    assert got == ['LAUT <a href="File:z">File:z</a>', ' <a href="Datei:x">Datei:x</a> ']
