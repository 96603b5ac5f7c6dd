"""Options, fixed lists and the language registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

Rule = Callable[[Column], Column]

# ---------------------------------------------------------------------------
# They decide which markup is dropped, so they must be these.

IGNORED_TAGS = (
    "big", "blockquote", "center", "cite", "div", "em", "font",
    "h1", "h2", "h3", "h4", "hiero", "kbd", "nowiki", "s", "tt", "var",
)
DISCARD_ELEMENTS = (
    "gallery", "timeline", "noinclude", "pre",
    "table", "tr", "td", "th", "caption",
    "form", "input", "select", "option", "textarea",
    "ul", "li", "ol", "dl", "dt", "dd", "menu", "dir",
    "ref", "references", "img", "imagemap", "source",
)
SELF_CLOSING_TAGS = ("br", "hr", "nobr", "ref", "references")
PLACEHOLDER_TAGS = (("code", "codice"),)

ENGLISH_NAMESPACES = (
    "Blog", "Category", "Category talk", "Discussion", "File", "Figure",
    "File talk", "Forum", "Forum talk", "Help", "Help talk", "MediaWiki",
    "MediaWiki talk", "Talk", "Template", "Template talk", "User", "User blog",
    "User talk", "User blog comment",
)
FRENCH_NAMESPACES = (
    "Modèle", "Catégorie", "Portail", "Fichier", "Wikipédia", "Projet",
    "Référence", "MediaWiki", "Aide", "Module", "File",
)

REQUIRED_METADATA = ("lang-code", "lang-local", "lang-english", "type", "source", "author")
METADATA_VERSION = "2.5"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Options:
    """Switches of the conversion.

    ``lists``: ``"verbatim"`` keeps list lines as they are, ``"html"`` turns
    ``*`` lines into nested ``<ul><li>``. ``rule_sets``: names of optional
    template rules, of those that the page's language has; in French ``"notes"``
    (remarks such as ``[pas clair]``) and ``"colours"`` (coloured text).
    """

    keep_links: bool = True
    keep_sections: bool = True
    lists: str = "verbatim"
    use_language_rules: bool = True
    rule_sets: tuple[str, ...] = ()
    ignored_tags: tuple[str, ...] = IGNORED_TAGS
    discard_elements: tuple[str, ...] = DISCARD_ELEMENTS
    self_closing_tags: tuple[str, ...] = SELF_CLOSING_TAGS
    placeholder_tags: tuple[tuple[str, str], ...] = PLACEHOLDER_TAGS

    def __post_init__(self) -> None:
        if self.lists not in ("verbatim", "html"):
            raise ValueError(f"lists must be 'verbatim' or 'html', not {self.lists!r}")


@dataclass(frozen=True)
class Language:
    """A language plug-in: disallowed title prefixes and template rules.

    A rule is a ``TemplateRule``, which sees one template at a time, or a
    function of the whole text column, such as a Python function needs.
    ``optional``: sets of further rules by name, switched on by
    ``Options.rule_sets``; they come before the others.
    """

    code: str
    namespaces: tuple[str, ...]
    rules: tuple[Rule, ...] = field(default=())
    optional: Mapping[str, tuple[Rule, ...]] = field(default_factory=dict)


ENGLISH = Language("en", ENGLISH_NAMESPACES)


class Languages:
    """Registry ``lang -> Language`` of one wiki type; others use the default."""

    def __init__(self, *languages: Language, default: Language = ENGLISH,
                 wikitype: str = "wikipedia") -> None:
        self.default = default
        self.wikitype = wikitype
        self._by_code = {language.code: language for language in languages}

    def register(self, language: Language) -> "Languages":
        return Languages(*(self._by_code | {language.code: language}).values(),
                         default=self.default, wikitype=self.wikitype)

    def special(self) -> list[Language]:
        """Languages that differ from the default."""
        return list(self._by_code.values())

    def choose(self, wikitype: str | None, lang: str | None) -> Language:
        if wikitype == self.wikitype:
            return self._by_code.get(lang, self.default)
        return self.default


def standard_languages() -> Languages:
    from wikiloom.functions.french import FRENCH_RULES, OPTIONAL_FRENCH_RULES

    return Languages(Language("fr", FRENCH_NAMESPACES, FRENCH_RULES, OPTIONAL_FRENCH_RULES))
