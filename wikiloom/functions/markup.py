"""Quotes, HTML tags, entities and punctuation."""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import name2codepoint
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.config import DISCARD_ELEMENTS, IGNORED_TAGS, PLACEHOLDER_TAGS, SELF_CLOSING_TAGS
from wikiloom.functions.expr import MARK, Step, bind, compose, if_contains, rewrite_matches

# End of a tag name; \b is not ASCII-only on every Java version.
_END = r"(?![A-Za-z0-9_])"


# --- quotes ----------------------------------------------------------------

def bold_italic(text: Column) -> Column:
    """Five quotes become italic."""
    return F.regexp_replace(text, r"'''''([^']*+)'''''", "<i>$1</i>")


def bold(text: Column) -> Column:
    return F.regexp_replace(text, r"'''([^\n]*?)'''", "<b>$1</b>")


def italic_quote(text: Column) -> Column:
    return F.regexp_replace(text, r"''\"([^\n]*?)\"''", "&quot;$1&quot;")


def italic(text: Column) -> Column:
    """Two quotes; a space follows the closing tag."""
    return F.regexp_replace(text, r"''([^']*+)''", "<i>$1</i> ")


def double_quotes(text: Column) -> Column:
    return F.regexp_replace(text, r'""([^\n]*?)""', "$1")


def leftover_quotes(text: Column) -> Column:
    return if_contains(text, "''", lambda t: F.replace(
        F.replace(t, F.lit("'''"), F.lit("")), F.lit("''"), F.lit("&quot;")))


# All quote rules in order, each only on texts that hold its quotes.
QUOTE_STEPS = (
    lambda text: if_contains(text, "'''''", bold_italic),
    lambda text: if_contains(text, "'''", bold),
    lambda text: if_contains(text, "''\"", italic_quote),
    lambda text: if_contains(text, "''", italic),
    lambda text: if_contains(text, '""', double_quotes),
    leftover_quotes,
)


def quotes(text: Column) -> Column:
    return compose(QUOTE_STEPS)(text)


# --- entities --------------------------------------------------------------

# The HTML 4 names and their characters, split into two arrays that Spark folds once.
_ENTITY_NAMES = MARK.join(name2codepoint)
_ENTITY_CHARACTERS = MARK.join(map(chr, name2codepoint.values()))


def _code_point(entity: Column) -> Column:
    """Code point of ``&#n;`` or ``&#xh;`` as 8 hexadecimal digits, else null."""
    decimal = F.regexp_extract(entity, r"^&#0*([0-9]{1,7});$", 1)
    hexadecimal = F.regexp_extract(entity, r"^&#x0*([0-9a-fA-F]{1,6});$", 1)
    digits = (F.when(decimal != "", F.hex(decimal.try_cast("int")))
              .when(hexadecimal != "", F.upper(hexadecimal)))
    return F.lpad(digits, 8, "0")


def _character(entity: Column) -> Column:
    code = _code_point(entity)
    legal = (code <= "0010FFFF") & ~code.between("0000D800", "0000DFFF")
    name = F.substring(entity, F.lit(2), F.length(entity) - 2)
    position = F.array_position(F.split(F.lit(_ENTITY_NAMES), MARK), name).cast("int")
    return F.coalesce(
        F.when(entity.startswith("&#"), F.when(legal, F.decode(F.unhex(code), "UTF-32")))
        .otherwise(F.get(F.split(F.lit(_ENTITY_CHARACTERS), MARK), position - 1)),
        entity,
    )


def unescape_once(text: Column) -> Column:
    """Resolve character references; unknown ones stay."""
    return if_contains(text, "&", lambda t: rewrite_matches(t, r"&#?\w+;", "&", _character))


def unescape_entities(text: Column) -> Column:
    """Two passes, since dumps hold ``&amp;nbsp;``."""
    return bind(unescape_once(text), unescape_once)


# --- tags ------------------------------------------------------------------

def _names(tags: Iterable[str]) -> str:
    return "(?:" + "|".join(tags) + ")"


# The patterns below first try an opening that nothing closes; the text from there
# on, which holds no further match, is kept at one go instead of being searched
# again from each opening in it.

def _apart(opening: str, cases: str) -> str:
    """``cases``, each begun by ``opening`` after a "<", one after the other; what is between them, in group 1, is taken at one go."""
    return rf"\G([^<]*+(?:<(?!{opening})[^<]*+)*+)(?:{cases}|\z)"


def drop_comments(text: Column) -> Column:
    body = r"<!--(?:[^-]++|-(?!->))*+"
    pattern = _apart("!--", rf"({body})\z|{body}-->")
    return if_contains(text, "<!--", lambda t: F.regexp_replace(t, pattern, "$1$2"))


def drop_self_closing(text: Column, tags: Iterable[str] = SELF_CLOSING_TAGS) -> Column:
    """The tag runs up to the next slash, which must end it."""
    opening = rf"\s*{_names(tags)}{_END}"
    body = rf"<{opening}[^/]*+"
    pattern = "(?i)" + _apart(opening, rf"({body}(?:/(?!\s*>)|\z))|{body}/\s*>")
    return if_contains(text, "<", lambda t: F.regexp_replace(t, pattern, "$1$2"))


def unwrap_ignored_tags(text: Column, tags: Iterable[str] = IGNORED_TAGS) -> Column:
    """Remove opening and closing tags, keep what they enclose."""
    names = _names(tags)
    opening = rf"<\s*{names}{_END}[^>]*+"
    pattern = "(?i)" + _apart(rf"\s*(?:{names}{_END}|/\s*{names}>)", rf"({opening})\z|{opening}>|<\s*/\s*{names}>")
    return if_contains(text, "<", lambda t: F.regexp_replace(t, pattern, "$1$2"))


# An element up to its closing tag; "@" stands for the name.
_ELEMENT = rf"<\s*@{_END}[^>]*+>(?:[^<]++|<(?!\s*/\s*@>))*+"


def drop_elements(text: Column, tags: Iterable[str] = DISCARD_ELEMENTS) -> Column:
    """Remove elements with their content, tag by tag in the given order.

    An element ends at the first closing tag of its name. One scan collects the
    names that are closed somewhere in the text; only those are searched for.
    """
    tags = tuple(tags)

    def remove(t: Column) -> Column:
        closed = F.transform(
            F.regexp_extract_all(t, F.lit(rf"(?i)<\s*/\s*({'|'.join(tags)})>"), F.lit(1)),
            lambda name: F.translate(name, ascii_uppercase, ascii_lowercase))
        return F.aggregate(
            F.array_intersect(F.array(*map(F.lit, tags)), closed),
            t,
            lambda rest, tag: F.regexp_replace(rest, element(tag), F.lit("$1")),
        )

    def element(tag: Column) -> Column:
        # First an element that nothing closes: the text from there on stays.
        return F.replace(F.lit(rf"(?is)(?=<)(?:({_ELEMENT})\z|{_ELEMENT}<\s*/\s*@>)"), F.lit("@"), tag)

    return if_contains(text, "<", remove)


def placeholders(text: Column, tags: Iterable[tuple[str, str]] = PLACEHOLDER_TAGS) -> Column:
    """Replace ``<code>…</code>`` by ``codice_i``.

    ``i`` is the position of the block's first copy in the page.
    """
    def label_of(blocks: Column, word: str) -> Step:
        return lambda block: F.concat(F.lit(word + "_"), F.array_position(blocks, block).cast("string"))

    def number(t: Column, tag: str, word: str) -> Column:
        pattern = code_pattern(tag)

        def replaced(blocks: Column) -> Column:
            label = label_of(blocks, word)
            # A block inside another one is replaced there too, so then one after the other.
            apart = F.regexp_count(t, F.lit(_code_opening(tag))) == F.size(blocks)
            return (F.when(F.size(blocks) == 0, t)
                    .when(apart, rewrite_matches(t, pattern, "<", label))
                    .otherwise(F.aggregate(F.array_distinct(blocks), t,
                                           lambda rest, block: F.replace(rest, block, label(block)))))

        return bind(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), replaced)

    def closed(t: Column, tag: str, word: str) -> Column:
        cut = bind(closed_part(t, tag), lambda head: F.concat(
            number(head, tag, word), F.substring(t, F.length(head) + 1, F.length(t))))
        # As a rule every opening begins a block of its own; then nothing is cut off.
        return bind(F.regexp_extract_all(t, F.lit(code_pattern(tag)), F.lit(0)), lambda blocks: F.when(
            F.regexp_count(t, F.lit(rf"(?i)<{_opens(tag)}")) != F.size(blocks), cut).when(F.size(blocks) == 0, t)
            .otherwise(rewrite_matches(t, code_pattern(tag), "<", label_of(blocks, word))))

    for tag, word in tags:
        text = bind(text, lambda t: if_contains(t, "<", lambda u: closed(u, tag, word)))
    return text


def _code_opening(tag: str) -> str:
    return rf"(?i)<\s*{tag}(?:\s*| [^>]++)>"


def code_pattern(tag: str) -> str:
    return rf"(?is:<\s*{tag}(?:\s*| [^>]++)>(?:[^<]++|<(?!\s*/\s*{tag}\s*>))*+<\s*/\s*{tag}\s*>)"


def closed_part(text: Column, tag: str) -> Column:
    """The text up to the first opening that nothing closes; no block comes after it."""
    return F.regexp_extract(text, rf"(?i)^((?:{code_pattern(tag)}|[^<]++|<(?!{_opens(tag)}))*+)", 1)


def _opens(tag: str) -> str:
    """What comes after the "<" of an opening, closed or not."""
    return rf"\s*{tag}(?:\s*(?:>|\z)| )"


# --- spaces and punctuation ------------------------------------------------

def tabs_to_space(text: Column) -> Column:
    return F.replace(text, F.lit("\t"), F.lit(" "))


def collapse_spaces(text: Column) -> Column:
    return if_contains(text, "  ", lambda t: F.regexp_replace(t, r" {2,}", " "))


def collapse_dots(text: Column) -> Column:
    return if_contains(text, "....", lambda t: F.regexp_replace(t, r"\.\.\.\.\.*+", "..."))


def drop_punctuation_lines(text: Column) -> Column:
    """Remove lines without an ASCII letter, digit or underscore."""
    return F.regexp_replace(text, r"\n\W+?\n", "\n")


def fix_commas(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(",,"), F.lit(",")), F.lit(",."), F.lit("."))


def cap_breaks(text: Column) -> Column:
    """At most two ``<br/>`` in a row."""
    return if_contains(text, "<br/><br/><br/>", lambda t: F.regexp_replace(t, r"(?:<br/>){3,}+", "<br/><br/>"))


def math_delimiters(text: Column) -> Column:
    return if_contains(text, "math>", lambda t: F.replace(
        F.replace(t, F.lit("<math>"), F.lit(r"\(")), F.lit("</math>"), F.lit(r"\)")))


# Spaces, dots, punctuation lines and commas in order.
TIDY_STEPS = (tabs_to_space, collapse_spaces, collapse_dots, drop_punctuation_lines, fix_commas)


def tidy(text: Column) -> Column:
    return compose(TIDY_STEPS)(text)
