"""Text operators over whole page tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.views import RICH_PAGES, WIKI_PAGES, joined, quote, view
from wikiloom.config import (DISCARD_ELEMENTS, ENGLISH_NAMESPACES, FRENCH_NAMESPACES, IGNORED_TAGS,
                             SELF_CLOSING_TAGS, Language, Options, standard_languages)
from wikiloom.functions import convert as C
from wikiloom.functions import french as R
from wikiloom.functions import lines as N
from wikiloom.functions import links as L
from wikiloom.functions import markup as M
from wikiloom.functions import nesting as B
from wikiloom.functions.expr import apply_steps
from wikiloom.plans.convert import convert_articles

HTML_PAGES = "SELECT page_id, 'en' AS lang, html AS wikitext FROM pages"
Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def replaced(text: str, *cases: tuple[str, str]) -> str:
    """SQL: regular expressions replaced one after the other, everywhere."""
    return reduce(lambda t, c: f"regexp_replace({t}, {quote(c[0])}, {quote(c[1])}, 'g')", cases, text)


def swapped(text: str, *cases: tuple[str, str]) -> str:
    """SQL: plain texts replaced one after the other."""
    return reduce(lambda t, c: f"replace({t}, {quote(c[0])}, {quote(c[1])})", cases, text)


def add(name: str, source: str, function: Callable[[Column], Column], sql: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return view(spark, sf_dir, source).select("page_id", function(F.col("wikitext")).alias("text"))

    QUERIES[name] = build
    ORACLES[name] = f"WITH p AS ({source}) SELECT page_id, {sql} AS text FROM p"


T = "wikitext"


def lang() -> Column:
    return F.col("lang")


# --- single steps ----------------------------------------------------------

FRENCH_DATE = (r"\{\{date\|(\d+)\|(\w+)\|(\d+)\}\}", r"\1 \2 \3")


def sql_rules(t: str) -> str:
    first = (r"\{\{date\|1\|", "{{date|1er|")
    date = (r"\{\{date\|(\w+)\|(\w+)\|(\d+)\}\}", r"\1 \2 \3")
    return f"CASE WHEN lang = 'fr' THEN {replaced(t, first, date)} ELSE {t} END"


def sql_templates(t: str) -> str:
    return replaced(t, *[(r"\{\{[^{}]*\}\}", "")] * 3)


def sql_tables(t: str) -> str:
    return replaced(t, (r"\{\|[^{}]*?\|\}", ""))


def sql_anchors(t: str, keep: bool = True) -> str:
    piped, plain = r"\[\[([^\[\]|]*)\|([^\[\]]+)\]\](\w*)", r"\[\[([^\[\]|]*)\|?\]\](\w*)"
    if keep:
        return replaced(t, (piped, r'<a href="\1">\2\3</a>'), (plain, r'<a href="\1">\1\2</a>'))
    return replaced(t, (piped, r"\2\3"), (plain, r"\1\2"))


def sql_namespaces(t: str) -> str:
    def drop(names):
        return replaced(t, (r"\[\[(?:" + "|".join(names) + r"):[^\[\]]*\]\]\w*", ""))
    return f"CASE WHEN lang = 'fr' THEN {drop(FRENCH_NAMESPACES)} ELSE {drop(ENGLISH_NAMESPACES)} END"


def drop_namespaces(t: Column) -> Column:
    return F.when(lang() == "fr", L.drop_namespace_links(t, FRENCH_NAMESPACES)).otherwise(
        L.drop_namespace_links(t, ENGLISH_NAMESPACES))


LEFTOVER = (r"\[\[.*?\]\]", "")
EXTERNAL = (r"\[\w+.*? (.*?)\]", r"\1")
BRACKETED = (r"\[\w+[&\]]*\]", "")
QUOTES = [(r"'''''([^']*?)'''''", r"<i>\1</i>"), (r"'''(.*?)'''", r"<b>\1</b>"),
          (r"''\"(.*?)\"''", r"&quot;\1&quot;"), (r"''([^']*)''", r"<i>\1</i> "), (r'""(.*?)""', r"\1")]
LEFTOVER_QUOTES = [("'''", ""), ("''", "&quot;")]
ENTITIES = [("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#233;", "é"),
            ("&amp;", "&")]
COMMENTS = (r"(?s)<!--.*?-->", "")
SELF_CLOSING = (rf"(?is)<\s*(?:{'|'.join(SELF_CLOSING_TAGS)})\b[^/]*/\s*>", "")
IGNORED = (rf"(?i)<\s*(?:(?:{'|'.join(IGNORED_TAGS)})\b[^>]*|/\s*(?:{'|'.join(IGNORED_TAGS)}))>", "")
ELEMENTS = [(rf"(?is)<\s*{tag}\b[^>]*>.*?<\s*/\s*{tag}>", "") for tag in DISCARD_ELEMENTS]
TIDY = dict(spaces=(" {2,}", " "), dots=(r"\.{4,}", "..."), lines=(r"\n\W+?\n", "\n"))
COMMAS = [(",,", ","), (",.", ".")]


def sql_entities(t: str) -> str:
    return swapped(t, *ENTITIES)


add("t00_apply_rules", WIKI_PAGES, lambda t: C.apply_rules(t, lang()), sql_rules(T))
add("t01_drop_templates", WIKI_PAGES, B.drop_templates, sql_templates(T))
add("t02_drop_tables", WIKI_PAGES, B.drop_tables, sql_tables(T))
add("t03_links_to_anchors", WIKI_PAGES, L.links_to_anchors, sql_anchors(T))
add("t03_links_to_anchors_rich", RICH_PAGES, L.links_to_anchors, sql_anchors(T))
add("t04_drop_namespace_links", WIKI_PAGES, drop_namespaces, sql_namespaces(T))
add("t04_drop_namespace_links_rich", RICH_PAGES, drop_namespaces, sql_namespaces(T))
add("t05_links_as_text", WIKI_PAGES, L.links_as_text, sql_anchors(T, keep=False))
add("t06_drop_leftover_links", RICH_PAGES, L.drop_leftover_links, replaced(T, LEFTOVER))
add("t07_external_link_labels", RICH_PAGES, L.external_link_labels, replaced(T, EXTERNAL))
add("t08_drop_bracketed_word", RICH_PAGES, L.drop_bracketed_word, replaced(T, BRACKETED))
for number, (function, case) in enumerate(
        zip((M.bold_italic, M.bold, M.italic_quote, M.italic, M.double_quotes), QUOTES), 9):
    add(f"t{number:02d}_{function.__name__}", RICH_PAGES, function, replaced(T, case))
add("t14_leftover_quotes", RICH_PAGES, M.leftover_quotes, swapped(T, *LEFTOVER_QUOTES))
add("t14_all_quotes", RICH_PAGES, M.quotes, swapped(replaced(T, *QUOTES), *LEFTOVER_QUOTES))
add("t15_unescape_entities", HTML_PAGES, M.unescape_entities, sql_entities(sql_entities(T)))
add("t15_unescape_entities_wiki", WIKI_PAGES, M.unescape_entities, sql_entities(sql_entities(T)))
add("t16_drop_comments", HTML_PAGES, M.drop_comments, replaced(T, COMMENTS))
add("t17_drop_self_closing", WIKI_PAGES, M.drop_self_closing, replaced(T, SELF_CLOSING))
add("t17_drop_self_closing_html", HTML_PAGES, M.drop_self_closing, replaced(T, SELF_CLOSING))
add("t18_unwrap_ignored_tags", HTML_PAGES, M.unwrap_ignored_tags, replaced(T, IGNORED))
add("t20_drop_elements", HTML_PAGES, M.drop_elements, replaced(T, *ELEMENTS))
add("t20_drop_elements_wiki", WIKI_PAGES, M.drop_elements, replaced(T, *ELEMENTS))
add("t21_placeholders", RICH_PAGES, M.placeholders, replaced(
    T, (r"(?is)<code>a\d+</code>", "codice_1"), (r"(?is)<code>b</code>", "codice_2"),
    (r"(?is)<code x>.*?</code>", "codice_3")))
add("t22_tabs_to_space", RICH_PAGES, M.tabs_to_space, f"replace({T}, chr(9), ' ')")
add("t23_collapse_spaces", RICH_PAGES, M.collapse_spaces, replaced(T, TIDY["spaces"]))
add("t24_collapse_dots", RICH_PAGES, M.collapse_dots, replaced(T, TIDY["dots"]))
add("t26_drop_punctuation_lines", RICH_PAGES, M.drop_punctuation_lines, replaced(T, TIDY["lines"]))
add("t27_fix_commas", RICH_PAGES, M.fix_commas, swapped(T, *COMMAS))
add("t37_cap_breaks", RICH_PAGES, M.cap_breaks, replaced(T, ("<br/>(<br/>(?:<br/>)+)", "<br/><br/>")))
add("t38_math_delimiters", RICH_PAGES, M.math_delimiters, swapped(T, ("<math>", "\\("), ("</math>", "\\)")))

# --- lines -----------------------------------------------------------------

LINES = f"string_split({T}, chr(10))"
IS_HEADING = " OR ".join(rf"regexp_matches(l, '^={{{n}}}\s*.*?\s*={{{n}}}')" for n in range(6, 1, -1))
LEVEL = "CASE " + " ".join(rf"WHEN regexp_matches(l, '^={{{n}}}\s*.*?\s*={{{n}}}') THEN {n}"
                           for n in range(6, 1, -1)) + " END"
HEADING_TITLE = "CASE " + " ".join(
    rf"WHEN regexp_matches(l, '^={{{n}}}\s*.*?\s*={{{n}}}') THEN regexp_extract(l, '^={{{n}}}\s*(.*?)\s*={{{n}}}', 1)"
    for n in range(6, 1, -1)) + " END"
HEADING_HTML = f"concat('<h', {LEVEL}, '>', {HEADING_TITLE}, '</h', {LEVEL}, '>')"
INNER = "substr(l, 3, greatest(length(l) - 4, 0))"
TITLE_HTML = f"CASE WHEN right({INNER}, 1) IN ('!', '?') THEN {INNER} ELSE concat({INNER}, '.') END"
IS_LIST = "left(l, 1) IN ('*', '#', ':', ';')"
IS_RESIDUE = "(left(l, 1) IN ('{', '|') OR right(l, 1) = '}')"
IS_IRRELEVANT = "((left(l, 1) = '(' AND right(l, 1) = ')') OR trim(l, '.-') = '')"


def sql_line(sections: bool = True) -> str:
    heading = HEADING_HTML if sections else "NULL"
    return (f"CASE WHEN l = '' THEN '<br/><br/>' WHEN {IS_HEADING} THEN {heading} "
            f"WHEN left(l, 2) = '++' THEN CASE WHEN {INNER} <> '' THEN {TITLE_HTML} END "
            f"WHEN {IS_LIST} THEN l WHEN {IS_RESIDUE} OR {IS_IRRELEVANT} THEN NULL ELSE l END")


def each_line(expr: str, condition: str = "true", between: str = "chr(10)") -> str:
    """SQL: lines that meet the condition, each changed, joined again."""
    return f"array_to_string([{expr} for l in {LINES} if {condition}], {between})"


def sql_compact(t: str = T, sections: bool = True) -> str:
    line = sql_line(sections)
    return f"array_to_string([x for x in [{line} for l in string_split({t}, chr(10))] if x IS NOT NULL], '')"


def by_line(function: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda t: F.array_join(F.transform(N.lines(t), lambda line: function(line)), "\n")


def by_lines(function: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda t: F.array_join(function(N.lines(t)), "\n")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, WIKI_PAGES).select("page_id", F.posexplode(N.lines(F.col(T))).alias("pos", "line"))


def sql_numbered(source: str) -> str:
    return (f"SELECT page_id, i - 1 AS pos, a[i] AS l FROM (SELECT page_id, a, unnest(range(1, len(a) + 1)) AS i "
            f"FROM (SELECT page_id, {LINES} AS a FROM ({source}) AS s) AS x) AS y")


QUERIES["t28_lines"] = _lines
ORACLES["t28_lines"] = f"SELECT page_id, cast(pos AS INTEGER) AS pos, l AS line FROM ({sql_numbered(WIKI_PAGES)}) AS n"
add("t29_blank_line_break", RICH_PAGES, by_line(N.blank_line_break),
    each_line("CASE WHEN l = '' THEN '<br/><br/>' ELSE l END"))
add("t30_headings", RICH_PAGES, by_line(N.headings), each_line(f"CASE WHEN {IS_HEADING} THEN {HEADING_HTML} ELSE l END"))
add("t31_title_line", RICH_PAGES, lambda t: N.join_lines(F.transform(N.lines(t), lambda x: N.title_line(x))),
    each_line(f"CASE WHEN left(l, 2) = '++' THEN {TITLE_HTML} ELSE l END", f"NOT (left(l, 2) = '++' AND {INNER} = '')", "''"))
add("t33_drop_table_residue", RICH_PAGES, by_lines(N.drop_table_residue), each_line("l", f"l = '' OR NOT {IS_RESIDUE}"))
add("t34_drop_irrelevant_lines", RICH_PAGES, by_lines(N.drop_irrelevant_lines),
    each_line("l", f"l = '' OR NOT {IS_IRRELEVANT}"))
add("t36_join_lines", WIKI_PAGES, lambda t: N.join_lines(N.lines(t)), f"replace({T}, chr(10), '')")
add("t39_drop_headings", RICH_PAGES, by_lines(N.drop_headings), each_line("l", f"NOT ({IS_HEADING})"))
add("t40_compact", RICH_PAGES, N.compact_to_html, sql_compact())
add("t40_compact_no_sections", RICH_PAGES, lambda t: N.compact_to_html(t, Options(keep_sections=False)),
    sql_compact(sections=False))
add("t32_list_lines", RICH_PAGES, N.list_lines, "NULL")
DEPTH = r"length(regexp_extract(l, '^\*+', 0))"
ORACLES["t32_list_lines"] = f"""
WITH n AS ({sql_numbered(RICH_PAGES)}),
marks AS (SELECT page_id, pos, {DEPTH} AS depth,
            coalesce(lag({DEPTH}) OVER (PARTITION BY page_id ORDER BY pos), 0) AS before
          FROM n WHERE l = '' OR left(l, 1) = '*'),
html AS (
  SELECT n.page_id, n.pos, CASE
    WHEN l = '' THEN concat(repeat('</ul>', before), '<br/><br/>')
    WHEN left(l, 1) = '*' THEN concat(repeat('<ul>', greatest(depth - before, 0)),
      repeat('</ul>', greatest(before - depth, 0)), '<li>', substr(l, depth + 1), '</li>')
    ELSE {sql_line()} END AS h
  FROM n LEFT JOIN marks m ON n.page_id = m.page_id AND n.pos = m.pos)
SELECT page_id, string_agg(h, '' ORDER BY pos) AS text FROM html GROUP BY page_id"""

# --- the chain -------------------------------------------------------------


def sql_clean(t: str, rules: bool = True, keep_links: bool = True) -> list[tuple[str, str]]:
    """The cleaning steps as (name, expression) pairs, each over the one before."""
    steps = ([sql_rules] if rules else []) + [
        sql_templates, sql_tables, sql_namespaces, lambda t: sql_anchors(t, keep_links),
        lambda t: replaced(t, LEFTOVER, EXTERNAL, BRACKETED),
        lambda t: swapped(replaced(t, *QUOTES), *LEFTOVER_QUOTES),
        sql_entities, sql_entities,
        lambda t: replaced(t, COMMENTS, SELF_CLOSING, IGNORED),
        lambda t: replaced(t, *ELEMENTS),
        lambda t: replaced(t, (r"(?is)<code>a\d+</code>", "codice_1"), (r"(?is)<code>b</code>", "codice_2"),
                           (r"(?is)<code x>.*?</code>", "codice_3"), (r"<code>k\d</code>", "codice_1")),
        lambda t: swapped(replaced(f"replace({t}, chr(9), ' ')", *TIDY.values()), *COMMAS)]
    return [(f"c{i}", step(t if i == 0 else "t")) for i, step in enumerate(steps)]


def sql_chain(source: str, last: str, columns: str = "page_id", **kwargs) -> str:
    keep = columns if "lang" in columns else columns + ", lang"
    parts, previous = [f"p AS ({source})"], "p"
    for name, expr in sql_clean(T, **kwargs):
        parts.append(f"{name} AS (SELECT {keep}, {expr} AS t FROM {previous})")
        previous = name
    return f"WITH {', '.join(parts)} SELECT {columns}, {last} FROM {previous}"


def sql_html(t: str = "t", sections: bool = True) -> str:
    capped = replaced(sql_compact(t, sections), ("<br/>(<br/>(?:<br/>)+)", "<br/><br/>"))
    return swapped(capped, ("<math>", "\\("), ("</math>", "\\)"))


def chain(steps_of: Callable, source: str) -> Build:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = view(spark, sf_dir, source)
        return apply_steps(pages, T, steps_of()).select("page_id", F.col(T).alias("text"))
    return build


for suffix, source in (("", WIKI_PAGES), ("_rich", RICH_PAGES)):
    QUERIES[f"t41_clean{suffix}"] = chain(lambda: C.clean_steps(lang()), source)
    ORACLES[f"t41_clean{suffix}"] = sql_chain(source, "t AS text")
    QUERIES[f"t42_convert{suffix}"] = chain(lambda: C.convert_steps(lang()), source)
    ORACLES[f"t42_convert{suffix}"] = sql_chain(source, f"{sql_html()} AS text")

ROUTED = (f"SELECT *, CASE WHEN coalesce(redirect_to, '') <> '' THEN 'redirect' "
          "WHEN coalesce(length(wikitext), 0) > 0 AND NOT (instr(title, ':') > 1 AND CASE WHEN lang = 'fr' "
          f"THEN split_part(title, ':', 1) IN ({', '.join(map(quote, FRENCH_NAMESPACES))}) "
          f"ELSE split_part(title, ':', 1) IN ({', '.join(map(quote, ENGLISH_NAMESPACES))}) END) THEN 'article' "
          f"ELSE 'dropped' END AS kind FROM ({WIKI_PAGES}) AS w")
ARTICLE_PAGES = f"SELECT page_id, title, lang, wikitext FROM ({ROUTED}) AS r WHERE kind = 'article'"
ARTICLES_SQL = sql_chain(ARTICLE_PAGES, f"{sql_html()} AS html", "page_id, title")

QUERIES["t42_convert_articles"] = lambda spark, sf_dir: convert_articles(view(spark, sf_dir, WIKI_PAGES))
ORACLES["t42_convert_articles"] = ARTICLES_SQL

PLAIN = Options(keep_links=False, keep_sections=False, use_language_rules=False)
QUERIES["u03_options"] = chain(lambda: C.convert_steps(lang(), PLAIN), RICH_PAGES)
ORACLES["u03_options"] = sql_chain(RICH_PAGES, f"{sql_html(sections=False)} AS text", rules=False, keep_links=False)

GERMAN = Language("de", ("Datei", "File"), (lambda t: F.regexp_replace(t, r"\{\{date\|[^{}]*\}\}", "Datum"),))
QUERIES["u01_language_plugin"] = lambda spark, sf_dir: view(spark, sf_dir, WIKI_PAGES).select(
    "page_id", C.apply_rules(F.col(T), lang(), languages=standard_languages().register(GERMAN)).alias("text"))
ORACLES["u01_language_plugin"] = (
    f"WITH p AS ({WIKI_PAGES}) SELECT page_id, CASE WHEN lang = 'de' THEN "
    + replaced(T, (r"\{\{date\|[^{}]*\}\}", "Datum")) + f" ELSE {sql_rules(T)} END AS text FROM p")

# --- French rules ----------------------------------------------------------

_N, _M = "cast(doc_id % 24 as string)", "cast(n_chars % 60 as string)"
_WORD = "concat('mot ', cast(doc_id as string))"
_BIG = "cast(n_chars * 1000 + doc_id as string)"
_GROUPED = "replace(format('{:,}', n_chars * 1000 + doc_id), ',', ' ')"
_Y = "cast(1000 + doc_id % 1000 as string)"

# rule, template parts, expected parts; all parts are texts ("=…") or SQL.
FRENCH = [
    ("f01_hour", R.hour,
     ("={{heure|", _N, "=}} {{Heure|", _N, "=|", _M, "=}} {{heure|", _N, "=|", _M, "=|7}} {{heure|1|2|3|4}}"),
     (_N, "= h ", _N, "= h ", _M, "= ", _N, "= h ", _M, "= min 7 s ")),
    ("f02_nobr", R.nobr, ("={{nobr|", _WORD, "=}}"), ('=<span class="nowrap">', _WORD, "=</span>")),
    ("f03_temperature", R.temperature, ("={{tmp|", _N, "=|°C}}"), (_N, "=°C")),
    ("f04_formatnum", R.formatnum, ("={{formatnum:", _BIG, "=}} {{formatnum:", _BIG, "=.5}} {{formatnum:", _N, "=,5}}"),
     (_GROUPED, "= ", _GROUPED, "=,500000 ", _N, "=,5")),
    ("f05_unit", R.unit,
     ("={{Unité|", _BIG, "=}} {{unité|", _BIG, "=|km|2}} {{nombre|", _BIG, "=,25|m||s|-1}} {{num|", _BIG, "=|e=15}}"),
     (_GROUPED, "= ", _GROUPED, "= km<sup>2</sup> ", _GROUPED, "=.25 m⋅s<sup>-1</sup> ", _GROUPED, "=×10<sup>15</sup>")),
    ("f06_small_numbers", R.small_numbers,
     ("={{exp|", _N, "=}}{{ind|", _M, "=}}{{1er}}{{1re}}{{2nd}}{{e}}{{7}}{{2NDE}}{{2nde}}"),
     ("=<sup>", _N, "=</sup><sub>", _M, "=</sub>1<sup>er</sup>1<sup>re</sup>2<sup>nd</sup><sup>e</sup><sup>7</sup>"
      "2<sup>de</sup><sup>2nde</sup>")),
    ("f07_number_sign", R.number_sign, ("={{numéro}}", _N, "= {{nº}}", _M), ("=n°", _N, "= n°", _M)),
    ("f08_two_centuries", R.two_centuries,
     ("={{sp|", _N, "=|e|ou|", _M, "=|e|}} {{-sp-|", _N, "=|e|-|", _M, "=|er|s}}"),
     (_N, "=e ou ", _M, "=e siècle ", _N, "=e - ", _M, "=er siècles av. J.-C.")),
    ("f09_century", R.century,
     ("={{", _N, "=e siècle}} {{s|", _N, "=|e}} {{-s2-|", _N, "=|e|", _M, "=|e}} {{s2|", _M, "=|e}}"),
     (_N, "=e siècle ", _N, "=e siècle ", _N, "=e et ", _M, "=e siècles av. J.-C.  s2|", _M, "=|e")),
    ("f10_lang", R.lang,
     ("={{lang|en|", _WORD, "=}} {{lang-en|", _WORD, "=}} {{langue|ar|dir=rtl|texte=", _WORD, "=}} {{lang|en|[[", _WORD,
      "=|x]]}}"),
     (_WORD, "= ", _WORD, "= ", _WORD, "= [[", _WORD, "=|x]]")),
    ("f11_colours", R.colours, ("={{rouge|", _WORD, "=}} {{Gris|", _N, "=}}"), (_WORD, "= ", _N)),
    ("f12_incomplete_reference", R.incomplete_reference, ("={{Référence nécessaire|", _WORD, "=}}"),
     ("=<u>", _WORD, "=</u><sup>[ref incomplète??]</sup>")),
    ("f13_date", R.date,
     ("={{date|", "cast(doc_id % 27 + 2 as string)", "=|mai|", _Y, "=|en}} {{Date de naissance|1|juin|", _Y,
      "=}} {{date||mars|", _Y, "=}} {{date|2|avril}}"),
     ("cast(doc_id % 27 + 2 as string)", "= mai ", _Y, "= 1er juin ", _Y, "= mars ", _Y, "= 2 avril")),
    ("f14_who_what", R.who_what, ("={{qui|", _WORD, "=}} {{en quoi|", _N, "=}}"), (_WORD, "= ", _N)),
    ("f15_code", R.code, ("={{code|", _WORD, "=}}"),
     ('=<span style=\\"font-family:monospace, Courier\\">', _WORD, "=</span>")),
    ("f16_citation", R.citation, ("={{citation bloc|", _WORD, "=}}"), ("=«&#160;<i>", _WORD, "=</i>&#160;»")),
    ("f17_napoleon", R.napoleon, ("={{Napoléon Ier}} ", _N), ("=Napoléon I<sup>er</sup> ", _N)),
    ("f18_first_of_month", R.first_of_month, ("={{1er août}} ", _Y), ("=1<sup>er</sup> août ", _Y)),
    ("f19_japanese", R.japanese, ("={{japonais|", _WORD, "=|はっぱ隊||extra=", _N, "=}}"), (_WORD, "= (はっぱ隊, , ", _N, "=)")),
]
NOTES = [("f21_doubtful", R.doubtful, "douteux", "<sup>[douteux]</sup>"),
         ("f22_promotional", R.promotional, "pub !", "<sup>[passage promotionnel]</sup>"),
         ("f23_unpublished", R.unpublished, "passage inédit", "<sup>[interprétion personnelle]</sup>"),
         ("f24_unclear", R.unclear, "pas clair", "<sup>[pas clair]</sup>"),
         ("f25_incomprehensible", R.incomprehensible, "incomprénsible", "<sup>[incomprénsible]</sup>"),
         ("f26_imprecise", R.imprecise, "Précision nécessaire", "<sup>[précision néssaire]</sup>"),
         ("f27_style", R.style, "style", "")]
FRENCH += [(name, rule, (f"={{{{{word}|", _WORD, "=|date=1}}"), (_WORD, f"={note}")) for name, rule, word, note in NOTES]
FRENCH += [("f28_evasive", R.evasive, ("={{passage évasif|", _WORD, "=}}"),
            ("=<u>", _WORD, "=</u><sup>[evasif??]</sup>"))]


def add_french(name: str, function: Callable[[Column], Column], template: tuple, expected: tuple) -> None:
    source = f"SELECT doc_id AS page_id, {joined(*template, '= ', 'text')} AS wikitext FROM documents"

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Spark reads a backslash in a literal as an escape.
        pages = view(spark, sf_dir, source.replace("\\", "\\\\"))
        return pages.select("page_id", function(F.col("wikitext")).alias("text"))

    QUERIES[name] = build
    ORACLES[name] = f"SELECT doc_id AS page_id, {joined(*expected, '= ', 'text')} AS text FROM documents"


for name, rule, template, expected in FRENCH:
    add_french(name, rule, template, expected)

_ALL = [entry for entry in FRENCH if entry[1] in R.FRENCH_RULES]
_ALL_TEMPLATES = sum((t + ("= ; ",) for _, _, t, _ in _ALL), ())
_ALL_EXPECTED = sum((e + ("= ; ",) for _, _, _, e in _ALL), ())
add_french("f20_translate_fr", R.translate_fr, _ALL_TEMPLATES, _ALL_EXPECTED)
add_french("f20_translate_by_template", lambda t: C.apply_rules(t, F.lit("fr")), _ALL_TEMPLATES, _ALL_EXPECTED)

_DEPTH = 12
add_french("f20_deep_templates", lambda t: C.apply_rules(t, F.lit("fr")),
           ("={{box|" + "{{nobr|" * _DEPTH + "{{date|1|mai|", _Y, "=}}" + "}}" * _DEPTH + "}} {{open {{nobr|", _WORD, "=}}"),
           ("={{box|" + '<span class="nowrap">' * _DEPTH + "1er mai ", _Y, "=" + "</span>" * _DEPTH
            + '}} {{open <span class="nowrap">', _WORD, "=</span>"))
add_french("u03_rule_sets", lambda t: C.apply_rules(t, F.lit("fr"), rule_sets=("notes", "colours")),
           ("={{rouge|", _WORD, "=}} {{pas clair|", _N, "=}} {{heure|", _N, "=}}"),
           ("=<font color='red'>", _WORD, "=</font> ", _N, "=<sup>[pas clair]</sup> ", _N, "= h"))
