"""Title search: a token table and conjunctive lookups in it."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens are ASCII letters and digits and all characters beyond ASCII.
_SEPARATORS = r"[\x00-/:-@\[-`{-\x7f]+"


def title_tokens(title: Column) -> Column:
    lowered = F.translate(title, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.array_distinct(F.split(lowered, _SEPARATORS)), lambda t: t != "")


def title_index(articles: DataFrame) -> DataFrame:
    """``token, article_id, title``: one row per article and different token."""
    return articles.select(F.explode(title_tokens(F.col("title"))).alias("token"), "article_id", "title")


def initial_name(first: str) -> str:
    """The folder of a token by its first character."""
    return first if first in string.ascii_lowercase + string.digits else "other"


def query_tokens(query: str | Sequence[str]) -> list[str]:
    """The tokens of the terms, cut as titles are; a star stays with a term's last one."""
    lower, tokens = str.maketrans(string.ascii_uppercase, string.ascii_lowercase), []
    for term in query.split() if isinstance(query, str) else query:
        parts = [t for t in re.split(_SEPARATORS, term.translate(lower)) if t]
        if parts and term.endswith("*"):
            parts[-1] += "*"
        tokens += parts
    return list(dict.fromkeys(tokens))


def search_titles(index: DataFrame, query: str | Sequence[str]) -> DataFrame:
    """Articles whose titles hold all terms; ``term*`` is a prefix.

    Terms are cut into tokens as titles are, so ``foo-bar`` and ``(foo)`` are
    found. If the index has the ``initial`` of its tokens, as when it is stored
    by it, only the folders of the terms are read.
    """
    terms = query_tokens(query)
    if not terms:
        raise ValueError("a search needs at least one term")

    def matches(term: str) -> Column:
        return F.col("token").startswith(term[:-1]) if term.endswith("*") else F.col("token") == term

    tests = [matches(term) for term in terms]
    if "initial" in index.columns:
        index = index.where(F.col("initial").isin(sorted({initial_name(term[0]) for term in terms})))
    hit = tests[0]
    for test in tests[1:]:
        hit = hit | test
    all_found = F.bool_or(tests[0])
    for test in tests[1:]:
        all_found = all_found & F.bool_or(test)
    return (index.where(hit).groupBy("article_id", "title").agg(all_found.alias("_all"))
            .where("_all").select("article_id", "title"))
