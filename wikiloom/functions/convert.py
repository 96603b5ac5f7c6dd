"""The whole conversion as an ordered list of column steps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.config import Language, Languages, Options, standard_languages
from wikiloom.functions import links as L
from wikiloom.functions import markup as M
from wikiloom.functions.expr import Step, compose, if_contains
from wikiloom.functions.lines import compact_to_html
from wikiloom.functions.nesting import drop_tables, drop_templates
from wikiloom.functions.templates import TemplateRule, rewrite_templates


def speaks(language_code: str, lang: Column, wikitype: Column, languages: Languages) -> Column:
    """Whether a page is in that language, on a wiki the registry is for."""
    return (lang == language_code) & (wikitype == languages.wikitype)


def translate(text: Column, language: Language, rule_sets: Sequence[str] = ()) -> Column:
    """All template rules of one language, and the optional ones of the ``rule_sets`` that it has."""
    rules = [rule for name in rule_sets for rule in language.optional.get(name, ())] + list(language.rules)
    by_template = [rule for rule in rules if isinstance(rule, TemplateRule)]
    of_text = [rule for rule in rules if not isinstance(rule, TemplateRule)]
    result = rewrite_templates(text, by_template) if by_template else text
    return if_contains(result, "{{", lambda t: reduce(lambda c, rule: rule(c), of_text, t)) if of_text else result


def apply_rules(text: Column, lang: Column, wikitype: Column | None = None,
                languages: Languages | None = None, rule_sets: Sequence[str] = ()) -> Column:
    """Template rules of the page's language; other languages pass untouched."""
    languages = languages or standard_languages()
    wikitype = F.lit(languages.wikitype) if wikitype is None else wikitype
    result = text
    for language in languages.special():
        if language.rules:
            spoken = speaks(language.code, lang, wikitype, languages)
            result = F.when(spoken, translate(text, language, rule_sets)).otherwise(result)
    return result


def convert_links(text: Column, lang: Column, wikitype: Column | None = None,
                  languages: Languages | None = None, keep_links: bool = True) -> Column:
    """Links to anchors, without those into the language's namespaces."""
    languages = languages or standard_languages()
    wikitype = F.lit(languages.wikitype) if wikitype is None else wikitype
    result = L.links_to_anchors(text, languages.default.namespaces, keep_links)
    for language in languages.special():
        result = F.when(speaks(language.code, lang, wikitype, languages),
                        L.links_to_anchors(text, language.namespaces, keep_links)).otherwise(result)
    return result


def clean_steps(lang: Column, options: Options = Options(), languages: Languages | None = None,
                wikitype: Column | None = None) -> list[Step]:
    """Wikicode to text with simple html, still in lines."""
    languages = languages or standard_languages()
    rules: list[Step] = []
    if options.use_language_rules:
        rules = [lambda t: apply_rules(t, lang, wikitype, languages, options.rule_sets)]
    return rules + [
        drop_templates,
        drop_tables,
        lambda t: convert_links(t, lang, wikitype, languages, options.keep_links),
        L.drop_leftover_links,
        L.external_link_labels,
        L.drop_bracketed_word,
        *M.QUOTE_STEPS,
        M.unescape_once,
        M.unescape_once,  # again: dumps hold &amp;nbsp;
        M.drop_comments,
        lambda t: M.drop_self_closing(t, options.self_closing_tags),
        lambda t: M.unwrap_ignored_tags(t, options.ignored_tags),
        lambda t: M.drop_elements(t, options.discard_elements),
        lambda t: M.placeholders(t, options.placeholder_tags),
        *M.TIDY_STEPS,
    ]


def html_steps(options: Options = Options()) -> list[Step]:
    """Cleaned lines to one html string."""
    return [lambda t: compact_to_html(t, options), M.cap_breaks, M.math_delimiters]


def convert_steps(lang: Column, options: Options = Options(), languages: Languages | None = None,
                  wikitype: Column | None = None) -> list[Step]:
    return clean_steps(lang, options, languages, wikitype) + html_steps(options)


def clean(text: Column, lang: Column, **kwargs) -> Column:
    """``clean_steps`` as one column expression."""
    return compose(clean_steps(lang, **kwargs))(text)


def convert(text: Column, lang: Column, **kwargs) -> Column:
    """``convert_steps`` as one column expression."""
    return compose(convert_steps(lang, **kwargs))(text)
