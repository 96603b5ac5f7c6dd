"""The line pass: headings, lists, table residue, irrelevant lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.config import Options
from wikiloom.functions.expr import bind

HEADING = r"(?s)^(==+)\s*(.*?)\s*\1"
BREAK = "<br/><br/>"


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def join_lines(parts: Column) -> Column:
    return F.array_join(parts, "")


def blank_line_break(line: Column) -> Column:
    return F.when(line == "", F.lit(BREAK)).otherwise(line)


def is_heading(line: Column) -> Column:
    return line.startswith("==") & F.rlike(line, F.lit(HEADING))


def heading_level(line: Column) -> Column:
    return F.length(F.regexp_extract(line, HEADING, 1))


def heading_title(line: Column) -> Column:
    return F.regexp_extract(line, HEADING, 2)


def heading_html(line: Column) -> Column:
    level = heading_level(line).cast("string")
    return F.concat(F.lit("<h"), level, F.lit(">"), heading_title(line), F.lit("</h"), level, F.lit(">"))


def headings(line: Column) -> Column:
    """``== title ==`` to ``<h2>title</h2>``; the rest of the line goes."""
    return F.when(is_heading(line), heading_html(line)).otherwise(line)


def is_title_line(line: Column) -> Column:
    return line.startswith("++")


def title_html(line: Column) -> Column:
    """Inner text of ``++title++`` with a full stop; null when it is empty."""
    inner = F.substring(line, F.lit(3), F.greatest(F.length(line) - 4, F.lit(0)))
    stop = F.when(F.right(inner, F.lit(1)).isin("!", "?"), "").otherwise(".")
    return F.when(inner != "", F.concat(inner, stop))


def title_line(line: Column) -> Column:
    return F.when(is_title_line(line), title_html(line)).otherwise(line)


def is_list_line(line: Column) -> Column:
    return F.left(line, F.lit(1)).isin("*", "#", ":", ";")


def is_table_residue(line: Column) -> Column:
    return F.left(line, F.lit(1)).isin("{", "|") | line.endswith("}")


def is_irrelevant(line: Column) -> Column:
    in_parentheses = line.startswith("(") & line.endswith(")")
    dots = (line.startswith(".") | line.startswith("-")) & F.rlike(line, F.lit(r"^[.-]+\z"))
    return in_parentheses | dots


def drop_table_residue(parts: Column) -> Column:
    return F.filter(parts, lambda line: (line == "") | ~is_table_residue(line))


def drop_irrelevant_lines(parts: Column) -> Column:
    return F.filter(parts, lambda line: (line == "") | ~is_irrelevant(line))


def drop_headings(parts: Column) -> Column:
    return F.filter(parts, lambda line: ~is_heading(line))


def _line_html(line: Column, keep_sections: bool) -> Column:
    """Html of one line, null if the line goes."""
    heading = heading_html(line) if keep_sections else F.lit(None).cast("string")
    return (F.when(line == "", BREAK)
            .when(is_heading(line), heading)
            .when(is_title_line(line), title_html(line))
            .when(is_list_line(line), line)
            .when(is_table_residue(line) | is_irrelevant(line), F.lit(None).cast("string"))
            .otherwise(line))


def _star_depth(line: Column) -> Column:
    return F.length(F.regexp_extract(line, r"^\*+", 0))


def _with_lists(parts: Column, keep_sections: bool) -> Column:
    """Line pass that opens and closes ``<ul>``.

    Only ``*`` lines and empty lines change the list depth, so each of them
    needs just the one of them before it.
    """
    numbered = F.transform(parts, lambda line, i: F.struct(i.alias("at"), line.alias("line")))

    def steers(x: Column) -> Column:
        return (x["line"] == "") | x["line"].startswith("*")

    def steered(marks: Column) -> Column:
        def html(x: Column, i: Column) -> Column:
            before = F.coalesce(_star_depth(F.get(marks, i - 1)["line"]), F.lit(0))
            depth = _star_depth(x["line"])
            tags = (F.when(depth > before, F.repeat(F.lit("<ul>"), depth - before))
                    .otherwise(F.repeat(F.lit("</ul>"), before - depth)))
            item = F.concat(F.lit("<li>"), F.regexp_replace(x["line"], r"^\*+", ""), F.lit("</li>"))
            return F.struct(x["at"].alias("at"),
                            F.concat(tags, F.when(depth > 0, item).otherwise(BREAK)).alias("html"))

        return F.transform(marks, html)

    def both(all_lines: Column) -> Column:
        plain = F.transform(
            F.filter(all_lines, lambda x: ~steers(x)),
            lambda x: F.struct(x["at"].alias("at"), _line_html(x["line"], keep_sections).alias("html")))
        merged = F.array_sort(F.concat(bind(F.filter(all_lines, steers), steered), plain))
        return F.filter(F.transform(merged, lambda x: x["html"]), lambda h: h.isNotNull())

    return bind(numbered, both)


def compact(text: Column, options: Options = Options()) -> Column:
    """Array of html lines of a cleaned text."""
    parts = lines(text)
    if options.lists == "html":
        return _with_lists(parts, options.keep_sections)
    return F.filter(F.transform(parts, lambda line: _line_html(line, options.keep_sections)),
                    lambda h: h.isNotNull())


def compact_to_html(text: Column, options: Options = Options()) -> Column:
    """``join_lines(compact(text))``."""
    return join_lines(compact(text, options))


def list_lines(text: Column, options: Options = Options(lists="html")) -> Column:
    """Nested ``<ul><li>`` for ``*`` lines."""
    return compact_to_html(text, options)
