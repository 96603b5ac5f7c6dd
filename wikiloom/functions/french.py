"""French template rules, in the order they are applied.

Each rule is for templates of certain names and works on their arguments, in
which inner templates are replaced already. Names ignore case. Values in
replacements (words, tags, entities) are fixed values that results must equal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.expr import bind, replace_all
from wikiloom.functions.templates import Template, TemplateRule, given, rewrite_templates


def _rule(*names: str, pattern: str | None = None):
    """Makes a rule of a function of a template."""
    return lambda value: TemplateRule(value, names, pattern)


def _only(t: Template) -> Column:
    """The argument of a template with one, null for others."""
    return F.when((t.count == 1) & given(t.arg(0)), t.arg(0))


def _all(t: Template) -> Column:
    """All arguments as one text, null without any."""
    return F.when(given(t.rest), t.rest)


# --- numbers ---------------------------------------------------------------

def _group_digits(digits: Column) -> Column:
    """Spaces between groups of three, counted from the right."""
    return F.reverse(F.regexp_replace(F.reverse(digits), r"([0-9]{3})(?=[0-9])", "$1 "))


def _strip_zeros(number: Column) -> Column:
    """Text of an integer as written by a computer: no plus, no leading zeros."""
    return replace_all(number, [(r"^\+", ""), (r"^(-?)0+(?=[0-9])", "$1"), (r"^-0$", "0")])


def _localised(number: Column) -> Column:
    """Integer part grouped, decimals after a point; other text stays."""
    parts = F.split(F.translate(F.replace(number, F.lit(" "), F.lit("")), ",", "."), r"\.", -1)

    def join(p: Column) -> Column:
        whole = F.get(p, F.lit(0))
        decimals = F.when(F.size(p) > 1, F.concat(F.lit("."), F.get(p, F.lit(1)))).otherwise("")
        return (F.when(F.rlike(whole, F.lit("^[+-]?[0-9]+$")),
                       F.concat(_group_digits(_strip_zeros(whole)), decimals))
                .otherwise(number))

    return bind(parts, join)


@_rule(pattern="^formatnum:[0-9.,]+$")
def formatnum(t: Template) -> Column:
    """``{{formatnum:1000}}`` to ``1 000``; a point gives six decimals."""

    def number(n: Column) -> Column:
        fixed = F.translate(F.format_number(n.try_cast("double"), 6), ",.", " ,")
        has_mark = (F.instr(n, ".") > 1) | (F.instr(n, ",") > 1)
        return (F.when(~has_mark & F.rlike(n, F.lit("^[0-9]+$")), _group_digits(_strip_zeros(n)))
                .when(has_mark & F.rlike(n, F.lit(r"^[0-9]+\.[0-9]*$")), fixed)
                .otherwise(n))

    return F.when(t.count == 0, bind(F.substring(t.body, F.lit(len("formatnum:") + 1), F.length(t.body)), number))


# In "|km||s|-1" the names are km and s; an empty argument or a number ends a factor.
_NAMES = r"(?:\|(?!-?[0-9])[^|]++)*+"
# Names at the end, which no exponent follows, are taken along, so that they are not searched again.
_FACTORS = rf"{_NAMES}(?:(?:\|(?:-?[0-9][^|]*+)?(?=\||\z))++|\z)"
_MARKED = r"\|(?=[^|=]++=)[^|]{2}"



@_rule("unité", "unite", "nombre", "num", "nau")
def unit(t: Template) -> Column:
    """``{{unité|10000|km|2}}`` to ``10 000 km<sup>2</sup>``.

    After the number come factors: names, of which the last one counts, and the
    exponents it is raised to, an empty one for none. A marked exponent, as in
    ``e=k``, is one of ten. Names that nothing follows count if there is no
    factor.
    """

    def factors(run: Column) -> Column:
        names = F.regexp_extract(run, f"^{_NAMES}", 0)
        exponents = F.split(F.substring(run, F.length(names) + 2, F.length(run)), r"\|", -1)
        name = F.substring_index(names, "|", -1)
        return F.transform(exponents, lambda e: F.concat(
            name, F.when(e == "", "").otherwise(F.concat(F.lit("<sup>"), _localised(e), F.lit("</sup>")))))

    def measure(rest: Column, of_ten: Column) -> Column:
        def joined(parts: Column) -> Column:
            power_first = of_ten & (F.size(parts) > 1) & F.get(parts, F.lit(0)).startswith("<sup>")
            return F.when(F.size(parts) == 0, F.substring_index(rest, "|", -1)).when(
                power_first, F.concat(F.get(parts, F.lit(0)), F.lit(" ⋅"), F.array_join(F.slice(parts, 2, F.size(parts) - 1), "⋅"))
            ).otherwise(F.array_join(parts, "⋅"))

        runs = F.filter(F.regexp_extract_all(rest, F.lit(_FACTORS), F.lit(0)),
                        lambda run: F.length(run) > F.length(F.regexp_extract(run, f"^{_NAMES}", 0)))
        return bind(F.flatten(F.transform(runs, factors)), joined)

    def value(body: Column) -> Column:
        number = F.substring_index(body, "|", 1)
        rest = F.substring(body, F.length(number) + 1, F.length(body))
        of_ten = F.rlike(rest, F.lit(_MARKED))
        plain = F.regexp_replace(rest, _MARKED, "|")
        return F.when(rest == "", _localised(number)).otherwise(F.concat(
            _localised(number), F.when(of_ten, "×10").otherwise(" "), bind(plain, lambda r: measure(r, of_ten))))

    return F.when(given(t.arg(0)), bind(t.rest, value))


@_rule("heure")
def hour(t: Template) -> Column:
    """Hours, minutes and seconds of one or two digits; more of them give nothing."""
    h, m, s = (t.arg(i) for i in range(3))
    written = (F.when(t.count == 1, F.concat(h, F.lit(" h")))
               .when(t.count == 2, F.concat(h, F.lit(" h "), m))
               .when(t.count == 3, F.concat(h, F.lit(" h "), m, F.lit(" min "), s, F.lit(" s")))
               .otherwise(""))
    return F.when((t.count > 0) & F.forall(t.args, lambda a: F.rlike(a, F.lit(r"^\d\d?$"))), written)


@_rule("tmp")
def temperature(t: Template) -> Column:
    return F.when((t.count == 2) & given(t.arg(0)) & (F.lower(t.arg(1)) == "°c"), F.concat(t.arg(0), F.lit("°C")))


@_rule("exp", "ind", "e", "1er", "1re", "2nde", "2nd", *map(str, range(10)))
def small_numbers(t: Template) -> Column:
    """Exponents, indices and ordinals; only lower-case names have their own form."""
    def raised(text: Column, tag: str = "sup") -> Column:
        return F.concat(F.lit(f"<{tag}>"), text, F.lit(f"</{tag}>"))

    pair = t.name.isin("exp", "ind")
    return (F.when(pair & ~given(t.rest), None)
            .when(t.written == "exp", raised(t.rest)).when(t.written == "ind", raised(t.rest, "sub")).when(pair, "")
            .when(t.count > 0, None)
            .when(t.written.isin("1er", "1re", "2nd"), F.concat(F.left(t.written, F.lit(1)), raised(F.substring(t.written, 2, 2))))
            .when(t.written == "2NDE", "2<sup>de</sup>")
            .otherwise(raised(t.written)))


@_rule("numéro", "n°", "nº")
def number_sign(t: Template) -> Column:
    return F.when(t.count == 0, "n°")


# --- time ------------------------------------------------------------------

_BC = " av. J.-C."
_ENDINGS = ("e", "er")


@_rule("sp", "-sp", "sp-", "-sp-")
def two_centuries(t: Template) -> Column:
    """``{{sp|VII|e|ou|VIII|e|s}}`` to ``VIIe ou VIIIe siècles``; a minus in front for those before our era."""
    many = F.lower(t.arg(5)) == "s"
    first, last = F.lower(t.arg(1)).isin(*_ENDINGS), F.lower(t.arg(4))
    complete = (F.when(t.count == 6, last.isin(*_ENDINGS) & (many | (t.arg(5) == "")))
                .otherwise((t.count == 5) & last.isin(*_ENDINGS, *(e + "s" for e in _ENDINGS))))
    text = F.concat(t.arg(0), t.arg(1), F.lit(" "), t.arg(2), F.lit(" "), t.arg(3), t.arg(4),
                    F.when(many, " siècles").otherwise(" siècle"), F.when(t.name.startswith("-"), _BC).otherwise(""))
    return F.when(complete & first & given(t.arg(0)) & given(t.arg(2)) & given(t.arg(3)), text)


def _without_last_empty(args: Column) -> Column:
    return F.when(F.get(args, F.size(args) - 1) == "", F.slice(args, F.lit(1), F.size(args) - 1)).otherwise(args)


_CENTURIES = tuple(f"{minus}{word}{end}" for minus in ("", "-") for word in ("s", "s2") for end in ("", "-"))


@_rule(*_CENTURIES, pattern="(?s).(?:si[^\n]cle|mill[^\n]naire)")
def century(t: Template) -> Column:
    """``{{s|III|e}}``, ``{{s2|III|e|IX|e}}`` and ``{{XXe siècle}}``.

    Any other number of centuries after ``s2`` leaves the arguments.
    """
    ending = F.when(t.name.startswith("-"), _BC + " ").otherwise("")

    def text(args: Column) -> Column:
        even = F.forall(F.transform(args, lambda a, i: F.when(i % 2 == 0, a != "").otherwise(F.lower(a) == "e")), lambda ok: ok)
        two = F.concat(F.get(args, F.lit(0)), F.lit("e et "), F.get(args, F.lit(2)), F.lit("e siècles"), ending)
        pairs = F.contains(t.written, F.lit("s2"))
        return F.when((F.size(args) > 0) & (F.size(args) % 2 == 0) & even,
                      F.when(pairs & (F.size(args) == 4), two)
                      .when(pairs, F.concat(t.written, F.lit("|"), F.array_join(args, "|")))
                      .otherwise(F.concat(F.get(args, F.lit(0)), F.lit("e siècle"), ending)))

    spelled = F.when(t.rest == "", t.written)
    return F.when(t.name.isin(*_CENTURIES), bind(_without_last_empty(t.args), text)).otherwise(spelled)


@_rule("date", "date de naissance", "date de décès")
def date(t: Template) -> Column:
    """``{{date|1|mai|2001}}`` to ``1er mai 2001``; day and year may be missing."""
    day, month = t.arg(0), t.arg(1)
    year = F.when(F.rlike(t.arg(2), F.lit(r"^\d+$")), t.arg(2)).otherwise("")
    before = F.when(day == "", "").when(day == "1", "1er ").otherwise(F.concat(day, F.lit(" ")))
    after = F.when(day == "", month).otherwise(F.regexp_replace(month, r"(?U)^\s+", ""))
    text = F.regexp_replace(F.concat(before, after, F.lit(" "), year), r"(?U)^\s+|\s+$", "")
    return F.when(F.rlike(day, F.lit(r"^(?:\d+(?:[eE][rR])?)?$")) & given(month), text)


_MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre",
           "décembre")
_PLAIN = str.maketrans("éû", "eu")


@_rule(*dict.fromkeys(f"1er {form}" for month in _MONTHS for form in (month, month.translate(_PLAIN))))
def first_of_month(t: Template) -> Column:
    return F.when(t.count == 0, F.concat(F.lit("1<sup>er</sup> "), F.substring(t.written, F.lit(5), F.length(t.written))))


# --- text ------------------------------------------------------------------

@_rule("nobr")
def nobr(t: Template) -> Column:
    return F.concat(F.lit('<span class="nowrap">'), _all(t), F.lit("</span>"))


def _holds_piped_link(text: Column) -> Column:
    """Whether a bar stands inside the brackets of the first line, from the first opening to the last closing."""
    line = F.substring_index(text, "\n", 1)
    after = F.substring(line, F.instr(line, "[[") + 2, F.length(line))
    inner = F.left(after, F.length(after) - F.length(F.substring_index(after, "]]", -1)) - 2)
    between = F.substring(inner, F.lit(2), F.length(inner) - 2)
    return F.contains(line, F.lit("[[")) & F.contains(after, F.lit("]]")) & F.contains(between, F.lit("|"))


@_rule("lang", "langue", pattern=r"^lang(?:ue)?-[\p{L}\p{N}_]+$")
def lang(t: Template) -> Column:
    """``{{lang|xx|text}}`` and ``{{lang-xx|text}}`` to the text.

    Bars of a link belong to the text. With further arguments the text is the
    one named ``texte``, nothing without it.
    """

    def value(rest: Column) -> Column:
        in_name = F.rlike(t.name, F.lit(r"^lang-\w"))
        named = F.regexp_extract(F.concat(F.lit("|"), rest), r"\|(?i:texte=)([^|\n]*+)", 1)
        one = ~F.contains(rest, F.lit("|"))
        return (F.when(in_name & ~_holds_piped_link(t.body), t.arg(0))
                .when(_holds_piped_link(t.body), rest)
                .when(one, F.replace(rest, F.lit("texte="), F.lit("")))
                .otherwise(named))

    after_code = F.substring(t.rest, F.length(t.arg(0)) + 2, F.length(t.rest))
    return F.when((t.count > 0) & F.forall(t.args, lambda a: a != ""), bind(after_code, value))


_COLOURS = (("rouge", "red"), ("bleu", "blue"), ("vert", "green"), ("jaune", "yellow"),
            ("orange", "orange"), ("gris", "grey"), ("marron", "brown"), ("rose", "pink"))
_COLOUR_NAMES = [name for name, _ in _COLOURS]


@_rule(*_COLOUR_NAMES)
def colours(t: Template) -> Column:
    """``{{rouge|x}}`` to ``x``."""
    return _only(t)


@_rule(*_COLOUR_NAMES)
def colours_as_font(t: Template) -> Column:
    """Option: ``{{rouge|x}}`` to a ``<font>`` element."""
    colour = F.try_element_at(F.create_map(*[F.lit(x) for pair in _COLOURS for x in pair]), t.name)
    return F.concat(F.lit("<font color='"), colour, F.lit("'>"), _only(t), F.lit("</font>"))


@_rule(pattern="(?s)^référence .")
def incomplete_reference(t: Template) -> Column:
    return F.concat(F.lit("<u>"), _only(t), F.lit("</u><sup>[ref incomplète??]</sup>"))


@_rule("qui", "lequel", "combien", "enquoi", "en quoi", "lesquels", "laquelle", "lesquelles", "par qui", "parqui", "pour qui")
def who_what(t: Template) -> Column:
    return _only(t)


@_rule("code")
def code(t: Template) -> Column:
    # The backslashes are part of the expected text.
    return F.concat(F.lit(r'<span style=\"font-family:monospace, Courier\">'), _only(t), F.lit("</span>"))


@_rule("citation", "citation ", *(f"citation{space}{kind}" for space in ("", " ") for kind in ("bloc", "nécessaire")))
def citation(t: Template) -> Column:
    return F.concat(F.lit("«&#160;<i>"), _all(t), F.lit("</i>&#160;»"))


@_rule("napoléon ier")
def napoleon(t: Template) -> Column:
    return F.when(t.count == 0, "Napoléon I<sup>er</sup>")


@_rule("japonais")
def japanese(t: Template) -> Column:
    """``{{japonais|a|b|c}}`` to ``a (b, c)``."""
    others = F.array_join(F.slice(t.args, F.lit(2), F.size(t.args)), ", ")
    return F.when((t.count > 1) & given(t.arg(0)) & given(others),
                  F.concat(t.arg(0), F.lit(" ("), F.replace(others, F.lit("extra="), F.lit("")), F.lit(")")))


FRENCH_RULES: tuple[TemplateRule, ...] = (
    hour, nobr, temperature, formatnum, unit, small_numbers, number_sign,
    two_centuries, century, lang, colours, incomplete_reference, date, who_what,
    code, citation, napoleon, first_of_month, japanese,
)


def translate_fr(text: Column) -> Column:
    """All rules, in every template."""
    return rewrite_templates(text, FRENCH_RULES)


# --- optional rules, not part of FRENCH_RULES ------------------------------

def _note(replacement: str, *names: str) -> TemplateRule:
    """The first argument and a note behind it."""
    return TemplateRule(lambda t: F.when(given(t.arg(0)), F.concat(t.arg(0), F.lit(replacement))), names)


doubtful = _note("<sup>[douteux]</sup>", "douteux")
promotional = _note("<sup>[passage promotionnel]</sup>", "passage promotionnel", "pub !", "promo !")
unpublished = _note("<sup>[interprétion personnelle]</sup>", "passage inédit")
unclear = _note("<sup>[pas clair]</sup>", "pas clair")
incomprehensible = _note("<sup>[incomprénsible]</sup>", "incomprénsible")
imprecise = _note("<sup>[précision néssaire]</sup>", "précision nécessaire")
style = _note("", "style")


@_rule("passage évasif")
def evasive(t: Template) -> Column:
    return F.concat(F.lit("<u>"), _all(t), F.lit("</u><sup>[evasif??]</sup>"))


#: Sets of further rules that ``Options.rule_sets`` switches on by name.
OPTIONAL_FRENCH_RULES: dict[str, tuple[TemplateRule, ...]] = {
    "notes": (doubtful, promotional, unpublished, unclear, incomprehensible, imprecise, style, evasive),
    "colours": (colours_as_font,),
}
