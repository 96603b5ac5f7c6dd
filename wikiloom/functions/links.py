"""Wiki links and external links."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.expr import MARK, if_contains

# A link holds no further "["; its target ends at the first "|" or "]]".
_TARGET = rf"(?:[^\[\]|{MARK}]++|\](?!\]))*+"
_LABEL = rf"(?:[^\[\]{MARK}]++|\](?!\]))"
LINK = rf"\[\[({_TARGET})(?:\|({_LABEL}*+))?\]\](\w*)"

# Two forms in one pattern; the groups of the form not taken are empty.
_LINK_FORMS = (
    rf"\[\[(?:({_TARGET})\|({_LABEL}++)\]\](\w*)"
    rf"|({_TARGET})\|?\]\](\w*))"
)
_AS_ANCHOR = '<a href="$1$4">$2$4$3$5</a>'
_AS_TEXT = "$2$4$3$5"

# Each pattern first tries an opening that its line never closes. Nothing after
# it on the line can close either, so the rest of the line is kept at one go.
_LEFTOVER_BODY = r"\[\[(?:[^\]\n]++|\](?!\]))*+"
_LEFTOVER = rf"({_LEFTOVER_BODY})(?=\n|\z)|{_LEFTOVER_BODY}\]\]"
# "[", a word character, the rest up to the first space, then the label.
_EXTERNAL = r"(?=\[)(?:(\[\w[^ \n]*+(?: [^\]\n]*+)?+)(?=\n|\z)|\[\w[^ \n]*+ ([^\]\n]*+)\])"
EXTERNAL_PARTS = r"\[(\w[^ \n]*+) ([^\]\n]*+)\]"
_BRACKETED_WORD = r"\[\w+[&\]]*\]"


def namespace_link_pattern(namespaces: Iterable[str]) -> str:
    names = "|".join(re.escape(name) for name in namespaces)
    return rf"\[\[(?:{names}):{_TARGET}(?:\|{_LABEL}*+)?\]\]\w*"


def _mark_namespace_links(text: Column, namespaces: Iterable[str]) -> Column:
    return F.regexp_replace(text, namespace_link_pattern(namespaces), MARK)


def _unmark(text: Column) -> Column:
    return F.replace(text, F.lit(MARK), F.lit(""))


def drop_namespace_links(text: Column, namespaces: Iterable[str]) -> Column:
    """Remove links into the given namespaces, with the letters that follow."""
    return if_contains(
        text, "[[", lambda t: _unmark(_mark_namespace_links(t, namespaces)))


def links_to_anchors(text: Column, namespaces: Iterable[str] = (), keep_links: bool = True) -> Column:
    """``[[target|label]]trail`` to ``<a href="target">label+trail</a>``.

    Links into ``namespaces`` go. The mark left in their place keeps the text
    on both sides from joining into a new link.
    """
    namespaces = tuple(namespaces)
    replacement = _AS_ANCHOR if keep_links else _AS_TEXT

    def rewrite(t: Column) -> Column:
        if not namespaces:
            return F.regexp_replace(t, _LINK_FORMS, replacement)
        marked = _mark_namespace_links(t, namespaces)
        return _unmark(F.regexp_replace(marked, _LINK_FORMS, replacement))

    return if_contains(text, "[[", rewrite)


def links_as_text(text: Column, namespaces: Iterable[str] = ()) -> Column:
    """Links become their label."""
    return links_to_anchors(text, namespaces, keep_links=False)


def drop_leftover_links(text: Column) -> Column:
    return if_contains(text, "[[", lambda t: F.regexp_replace(t, _LEFTOVER, "$1"))


def external_link_labels(text: Column) -> Column:
    """``[http://site label]`` to ``label``."""
    return if_contains(text, "[", lambda t: F.regexp_replace(t, _EXTERNAL, "$1$2"))


def drop_bracketed_word(text: Column) -> Column:
    return if_contains(text, "[", lambda t: F.regexp_replace(t, _BRACKETED_WORD, ""))
