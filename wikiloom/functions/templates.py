"""Templates ``{{name|argument|…}}`` at any depth, replaced by rules that are chosen by name.

Innermost templates come first, so a rule sees its arguments with all inner
templates replaced. One pass over a text handles all templates that hold no
other one; there are as many passes as closed templates are nested.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.expr import bind, if_contains

# Brackets and bars of templates that no rule is for, while the outer ones are looked at, and
# single braces, which never pair with what a rule leaves beside them. No legal XML characters.
_OPEN, _CLOSE, _BAR, _LEFT, _RIGHT = "\x02", "\x03", "\x04", "\x05", "\x06"
_INNERMOST = r"\{\{(?:[^{}]++|\{(?!\{)|\}(?!\}))*+\}\}"
_TOKENS = rf"{_INNERMOST}|\{{\{{|\}}\}}|[^{{}}]++|[{{}}]"


@dataclass(frozen=True)
class Template:
    """One template: all of its text, the first part as written and in lower case, and the arguments."""

    body: Column
    written: Column
    name: Column
    args: Column

    def arg(self, i: int) -> Column:
        """Null where there is no such argument."""
        return F.get(self.args, F.lit(i))

    @property
    def count(self) -> Column:
        return F.size(self.args)

    @property
    def rest(self) -> Column:
        """All arguments as one text."""
        return F.substring(self.body, F.length(self.written) + 2, F.length(self.body))


def given(value: Column) -> Column:
    """An argument that is there and not empty."""
    return F.coalesce(value != "", F.lit(False))


@dataclass(frozen=True)
class TemplateRule:
    """What stands for the templates with one of ``names``, or whose name holds ``pattern``.

    Names are in lower case. ``value`` gives null for arguments that the rule
    is not for; the template then stays. As a function of a text column the
    rule is applied alone.
    """

    value: Callable[[Template], Column]
    names: tuple[str, ...] = ()
    pattern: str | None = None

    def __call__(self, text: Column) -> Column:
        return rewrite_templates(text, [self])


def nesting_height(text: Column) -> Column:
    """How deep closed templates are nested: the largest fall of the depth, from any place to a later one."""

    def state(depth: Column, peak: Column, fall: Column) -> Column:
        return F.struct(depth.alias("depth"), peak.alias("peak"), fall.alias("fall"))

    def step(a: Column, bracket: Column) -> Column:
        depth = F.when(bracket == "{{", a["depth"] + 1).otherwise(F.greatest(a["depth"] - 1, F.lit(0)))
        return bind(F.struct(depth.alias("depth"), F.greatest(a["peak"], depth).alias("peak"), a["fall"].alias("fall")),
                    lambda b: state(b["depth"], b["peak"], F.greatest(b["fall"], b["peak"] - b["depth"])))

    brackets = F.regexp_extract_all(text, F.lit(r"\{\{|\}\}"), F.lit(0))
    zero = F.lit(0)
    return F.aggregate(brackets, state(zero, zero, zero), step, lambda a: a["fall"])


def _chosen(name: Column, rules: Sequence[TemplateRule]) -> Column:
    """The number of the rule for a name; of several the first."""
    by_name = {word: i for i, rule in reversed(list(enumerate(rules))) for word in rule.names}
    number = F.lit(None).cast("int")
    if by_name:
        number = F.try_element_at(F.create_map(*[F.lit(x) for pair in by_name.items() for x in pair]), name)
    for i, rule in enumerate(rules):
        if rule.pattern is not None:
            number = F.coalesce(number, F.when(F.rlike(name, F.lit(rule.pattern)), i))
    return number


def _replaced(token: Column, rules: Sequence[TemplateRule]) -> Column:
    """One innermost template, by its rule or set aside."""

    def value(t: Column) -> Column:
        template = Template(t["body"], F.get(t["parts"], F.lit(0)), t["name"], F.slice(t["parts"], F.lit(2), F.size(t["parts"])))
        cases = F.when(t["rule"] == 0, rules[0].value(template))
        for i, rule in enumerate(rules[1:], 1):
            cases = cases.when(t["rule"] == i, rule.value(template))
        kept = F.concat(F.lit(_OPEN), F.translate(t["body"], "|", _BAR), F.lit(_CLOSE))
        return F.translate(F.coalesce(cases, kept), "{}", _LEFT + _RIGHT)

    def parsed(body: Column) -> Column:
        name = F.lower(F.substring_index(body, "|", 1))
        return bind(F.struct(body.alias("body"), name.alias("name")), lambda t: bind(F.struct(
            t["body"].alias("body"), t["name"].alias("name"), F.split(t["body"], r"\|", -1).alias("parts"),
            _chosen(t["name"], rules).alias("rule")), value))

    return bind(F.substring(token, F.lit(3), F.length(token) - 4), parsed)


def rewrite_templates(text: Column, rules: Sequence[TemplateRule]) -> Column:
    """Replace every closed template that one of the ``rules`` is for; all else stays.

    An opening that is never closed stays, the templates after it count. The
    work grows with the length of the text and with how deep templates nest.
    """

    def one_pass(t: Column) -> Column:
        tokens = F.regexp_extract_all(t, F.lit(_TOKENS), F.lit(0))
        is_template = lambda x: x.startswith("{{") & (F.length(x) > 2)
        return F.array_join(F.transform(tokens, lambda x: F.when(is_template(x), _replaced(x, rules)).when(
            x == "{", _LEFT).when(x == "}", _RIGHT).otherwise(x)), "")

    def shown(t: Column) -> Column:
        t = F.translate(t, _BAR + _LEFT + _RIGHT, "|{}")
        return F.replace(F.replace(t, F.lit(_OPEN), F.lit("{{")), F.lit(_CLOSE), F.lit("}}"))

    def passes(height: Column) -> Column:
        return F.when(height > 0, bind(
            F.aggregate(F.sequence(F.lit(1), height), text, lambda t, _: one_pass(t)),
            lambda t: F.when(F.rlike(t, F.lit(f"[{_OPEN}-{_RIGHT}]")), shown(t)).otherwise(t))).otherwise(text)

    return if_contains(text, "{{", lambda _: bind(nesting_height(text), passes))
