"""Removal of nested blocks: templates ``{{…}}`` and tables ``{|…|}``.

The outermost balanced blocks go; a closing delimiter without a partner stays,
and so does everything from an opening delimiter that is never closed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.expr import bind, if_contains

# Nesting handled by the regular expression; deeper blocks take the fold.
REGEX_DEPTH = 8
# Tokens folded at a time; bounds the copying of the growing result.
FOLD_CHUNK = 256


@dataclass(frozen=True)
class Delimiters:
    open: str
    close: str
    open_re: str
    close_re: str
    inside: str      # text between delimiters of one level, possessive parts
    outside: str     # text before a block
    tokens: str      # delimiters, runs of other text, single delimiter characters


TEMPLATE = Delimiters(
    "{{", "}}", r"\{\{", r"\}\}",
    inside=r"[^{}]++|\{(?!\{)|\}(?!\})",
    outside=r"[^{]++|\{(?!\{)",
    tokens=r"\{\{|\}\}|[^{}]++|[{}]",
)
TABLE = Delimiters(
    "{|", "|}", r"\{\|", r"\|\}",
    inside=r"[^{|]++|\{(?!\|)|\|(?!\})",
    outside=r"[^{]++|\{(?!\|)",
    tokens=r"\{\||\|\}|[^{|}]++|[{|}]",
)


def _balanced(d: Delimiters, depth: int) -> str:
    block = f"{d.open_re}(?:{d.inside})*+{d.close_re}"
    for _ in range(depth - 1):
        block = f"{d.open_re}(?:{d.inside}|{block})*+{d.close_re}"
    return block


def _block_pattern(d: Delimiters, depth: int) -> str:
    # \G: blocks are taken one after the other, until one that does not close.
    # \z: the text after the last block counts as matched, so it is not searched.
    return f"\\G((?:{d.outside})*+)(?:{_balanced(d, depth)}|\\z)"


def _fold(text: Column, d: Delimiters) -> Column:
    """Any depth: walk over the tokens with the nesting level as state.

    ``out`` is the kept text, ``held`` the text since the outermost open
    delimiter, which is kept only if that is never closed.
    """
    def chunks(tokens):
        last = F.greatest((F.size(tokens) - 1) / FOLD_CHUNK, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last),
                           lambda i: F.slice(tokens, i * FOLD_CHUNK + 1, F.lit(FOLD_CHUNK)))

    def state(depth, out, held, closed):
        return F.struct(depth.alias("depth"), out.alias("out"), held.alias("held"),
                        closed.alias("closed"))

    def step(a, x):
        opens, closes = x == d.open, x == d.close
        outside = (a["depth"] == 0) & ~opens
        last = (a["depth"] == 1) & closes
        depth = (F.when(opens, a["depth"] + 1)
                 .when(closes & (a["depth"] > 0), a["depth"] - 1)
                 .otherwise(a["depth"]))
        return state(
            depth,
            F.when(outside, F.concat(a["out"], x)).otherwise(a["out"]),
            F.when(outside | last, F.lit("")).otherwise(F.concat(a["held"], x)),
            a["closed"] | outside | last,
        )

    def chunk(a, part):
        start = state(a["depth"], F.lit(""), F.lit(""), F.lit(False))
        return F.aggregate(part, start, step, lambda b: state(
            b["depth"],
            F.concat(a["out"], b["out"]),
            F.when(b["closed"], b["held"]).otherwise(F.concat(a["held"], b["held"])),
            F.lit(False),
        ))

    empty = state(F.lit(0), F.lit(""), F.lit(""), F.lit(False))
    tokens = F.regexp_extract_all(text, F.lit(d.tokens), F.lit(0))
    return F.aggregate(bind(tokens, chunks), empty, chunk, lambda a: F.concat(a["out"], a["held"]))


def _drop(text: Column, d: Delimiters, depth: int) -> Column:
    pattern = _block_pattern(d, depth)

    def blocks(t: Column) -> Column:
        return bind(F.regexp_replace(t, pattern, "$1"),
                    lambda r: F.when(F.contains(r, F.lit(d.open)), _fold(t, d)).otherwise(r))

    return if_contains(text, d.open, blocks)


def drop_templates(text: Column, regex_depth: int = REGEX_DEPTH) -> Column:
    """Remove ``{{…}}`` with everything nested inside."""
    return _drop(text, TEMPLATE, regex_depth)


def drop_tables(text: Column, regex_depth: int = REGEX_DEPTH) -> Column:
    """Remove ``{|…|}`` with everything nested inside."""
    return _drop(text, TABLE, regex_depth)
