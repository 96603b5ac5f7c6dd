"""Expected results of the French template rules, one pair per row."""

import pytest

from wikiloom.functions import french as fr

# All sentences are invented; each shows one form of a template.
LANG = [
    ("{{lang|it|forno}}", "forno"), ("le {{Lang|de|''Ofen''}} chaud", "le ''Ofen'' chaud"),
    ("{{langue|el|φούρνος}} et {{lang-pt|fornalha}}", "φούρνος et fornalha"), ("{{lang|el|texte=πηλός}}", "πηλός"),
    ("{{lang|el|dir=ltr|texte=πηλός}}", "πηλός"), ("{{lang|it|[[Forno|forni]]}}", "[[Forno|forni]]"),
    ("{{lang|it|dir=ltr|argilla}}", ""),
    ("{{lang|it|x=1|Texte=a\nb}}", "a"), ("{{lang-it|[[F|f]]|b}}", "f]]|b"), ("{{lang|it|[[F]] [[g|h]]}}", "[[F]] [[g|h]]"), ("{{lang|it|[[g|]]}}", ""),
]
MONTHS = ["mars", "août", "décembre", "février"]
FIRST_OF_MONTH = [("{{1er %s}} clair" % m, "1<sup>er</sup> %s clair" % m) for m in MONTHS]
DATE = [
    ("{{date|3|juin|1702}}", "3 juin 1702"), ("{{Date|1|juin|1702|au four}}", "1er juin 1702"), ("{{date||juin|1702}}", "juin 1702"),
    ("{{date|4|juin}}", "4 juin"), ("{{date de naissance|9|mai|1811}}, {{date de décès|2|mai|1890}}", "9 mai 1811, 2 mai 1890"),
]
SPELLED = [("au {{IVe siècle}} froid", "au IVe siècle froid"), ("le {{IIIe millénaire av. J.-C.}}", "le IIIe millénaire av. J.-C.")]
TWO_CENTURIES = [
    ("{{sp|II|e|puis|V|e|}}", "IIe puis Ve siècle"), ("{{sp-|X|e|ou|XI|e|s}}", "Xe ou XIe siècles"),
    ("{{-sp|V|e|ou|IV|e|s}}", "Ve ou IVe siècles av. J.-C."),
]
TEMPERATURE = [("cuire à {{tmp|1240|°C}} au plus", "cuire à 1240°C au plus")]
CENTURY = [
    ("{{s|IV|e}}", "IVe siècle"), ("{{-s-|II|e}}", "IIe siècle av. J.-C. "), ("{{s2|V|e|VI|e}}", "Ve et VIe siècles"),
    ("{{-s2|V|e|IV|e}}", "Ve et IVe siècles av. J.-C. "), ("{{s2|V|e}}", "s2|V|e"),
]
UNIT = [
    ("{{Unité|98765}}", "98 765"), ("{{unité|98765,4}}", "98 765.4"), ("{{unité|6.02|e=23}}", "6.02×10<sup>23</sup>"),
    ("{{nombre|4500|pots}}", "4 500 pots"), ("{{unité|31|cm|3}}", "31 cm<sup>3</sup>"), ("{{unité|12|kg||m|-3}}", "12 kg⋅m<sup>-3</sup>"),
    ("{{unité|3|m|2|3}}", "3 m<sup>2</sup>⋅m<sup>3</sup>"), ("{{unité|3|e=4||kg}}", "3×10<sup>4</sup> ⋅"),
    ("{{unité|3|a|kg|e=4|s|-2}}", "3×10kg<sup>4</sup>⋅s<sup>-2</sup>"), ("{{unité|3||2}}", "3 ⋅<sup>2</sup>"),
    ("{{unité|3|e=4|m|1500}}", "3×10<sup>4</sup> ⋅m<sup>1 500</sup>"), ("{{unité|3|a|b}}", "3 b"), ("{{unité|3|}}", "3 "),
    ("{{unité|-7.5|°C}}", "-7.5 °C"), ("{{num|x|pots}} {{nau|0042}}", "x pots 42"),
]

FORMATNUM = [
    ("{{formatnum:4500}} pots, {{formatnum:45}} fours", "4 500 pots, 45 fours"),
    ("{{formatnum:1234567.5}} {{formatnum:1234,5}} {{formatnum:1.2.3}} {{formatnum:,5}}",
     "1 234 567,500000 1234,5 1.2.3 ,5"),
    ("{{formatnum:0012345}} {{formatnum:000}} {{formatnum:1 000}}", "12 345 0 {{formatnum:1 000}}"),
    ("{{formatnum:123456789012345678901234567890}}", "123 456 789 012 345 678 901 234 567 890"),
]

JAPANESE = [
    ("{{japonais|four|窯}}", "four (窯)"), ("{{Japonais|four|窯|kama}}", "four (窯, kama)"),
    ("{{japonais|four|窯||cuisson}}", "four (窯, , cuisson)"), ("{{japonais|a|b|extra=c}}", "a (b, c)"),
]
NOBR = [
    ("{{nobr|deux pots}}", '<span class="nowrap">deux pots</span>'),
    ("{{nobr|31 cm{{exp|3}} net}}", '<span class="nowrap">31 cm<sup>3</sup> net</span>'),
]
HOUR = [
    ("{{heure|6}}", "6 h"), ("{{Heure|6|40}}", "6 h 40"), ("{{heure|6|40|09}}", "6 h 40 min 09 s"), ("{{heure|1|2|3|4}}", ""),
    ("{{heure|123}}", "{{heure|123}}"),
]

OTHERS = [
    ("x{{exp|2}} H{{ind|2}}O {{1er}} {{1re}} {{2nd}} {{e}} {{7}}",
     "x<sup>2</sup> H<sub>2</sub>O 1<sup>er</sup> 1<sup>re</sup> 2<sup>nd</sup> <sup>e</sup> <sup>7</sup>"),
    ("{{2NDE}} {{2nde}} {{E}} {{EXP|2}}", "2<sup>de</sup> <sup>2nde</sup> <sup>E</sup> "),
    ("{{numéro}} {{n°}} {{nº}} {{Numéro}} {{NUMÉRO}}", "n° n° n° n° n°"),
    ("{{rouge|chaud}} {{Bleu|froid}} {{rose|x}}", "chaud froid x"),
    ("{{Référence souhaitée|texte}}", "<u>texte</u><sup>[ref incomplète??]</sup>"),
    ("{{qui|certains}} {{par qui|eux}} {{qui|a}} b {{e}}", "certains eux a b <sup>e</sup>"),
    ("{{code|x = 1}}", '<span style=\\"font-family:monospace, Courier\\">x = 1</span>'),
    ("{{citation|mot}} {{Citation bloc|long}} {{citation nécessaire|là}}",
     "«&#160;<i>mot</i>&#160;» «&#160;<i>long</i>&#160;» «&#160;<i>là</i>&#160;»"),
    ("{{Napoléon Ier}}", "Napoléon I<sup>er</sup>"),
    ("{{infobox|x}} untouched $1 \\1", "{{infobox|x}} untouched $1 \\1"),
]

GROUPS = dict(lang=LANG, first_of_month=FIRST_OF_MONTH, date=DATE, spelled=SPELLED,
              two_centuries=TWO_CENTURIES, temperature=TEMPERATURE, century=CENTURY, unit=UNIT,
              formatnum=FORMATNUM, japanese=JAPANESE, nobr=NOBR, hour=HOUR, others=OTHERS)


@pytest.mark.parametrize("group", GROUPS)
def test_translate_fr(evaluate, group):
    pairs = GROUPS[group]
    assert evaluate(fr.translate_fr, [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_optional_rules(evaluate):
    cases = [
        (fr.doubtful, "{{douteux|x}} y {{douteux|z|date=1}}", "x<sup>[douteux]</sup> y z<sup>[douteux]</sup>"),
        (fr.promotional, "{{promo !|x}}", "x<sup>[passage promotionnel]</sup>"),
        (fr.unpublished, "{{passage inédit|x}}", "x<sup>[interprétion personnelle]</sup>"),
        (fr.unclear, "{{pas clair|x}}", "x<sup>[pas clair]</sup>"),
        (fr.incomprehensible, "{{incomprénsible|x}}", "x<sup>[incomprénsible]</sup>"),
        (fr.imprecise, "{{Précision nécessaire|x}}", "x<sup>[précision néssaire]</sup>"),
        (fr.style, "{{style|x|y}}", "x"),
        (fr.evasive, "{{passage évasif|x}}", "<u>x</u><sup>[evasif??]</sup>"),
        (fr.colours_as_font, "{{rouge|x}} {{gris|y}}", "<font color='red'>x</font> <font color='grey'>y</font>"),
    ]
    for rule, text, expected in cases:
        assert evaluate(rule, [text]) == [expected]


@pytest.mark.parametrize("group", GROUPS)
def test_language_rules(evaluate, group):
    """Template by template, as in the conversion."""
    from wikiloom.config import standard_languages
    from wikiloom.functions.convert import translate

    french = standard_languages().choose("wikipedia", "fr")
    pairs = GROUPS[group]
    assert evaluate(lambda t: translate(t, french), [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_rules_inside_other_templates(evaluate):
    from wikiloom.config import standard_languages
    from wikiloom.functions.convert import translate

    french = standard_languages().choose("wikipedia", "fr")
    deep = "{{x|" * 12 + "{{1er mai}}" + "}}" * 12
    strays = ["{{nobr|x}} text }} end", "{{japonais|a}} t {{japonais|b|c}}", "{{s|IV|e}} {{ {{heure|8}} }} }} {{", "{{{{heure|8}}"]
    both = [evaluate(rules, strays) for rules in (fr.translate_fr, lambda t: translate(t, french))]
    assert both[0] == both[1] == [
        '<span class="nowrap">x</span> text }} end', "{{japonais|a}} t b (c)", "IVe siècle {{ 8 h }} }} {{", "{{8 h"]
    texts = ["{{box|a={{date|2|mai|2001}}|{{s|III|e}}}} {{heure|8}} {{other}}", "{{open {{heure|8}}", deep]
    assert evaluate(lambda t: translate(t, french), texts) == [
        "{{box|a=2 mai 2001|IIIe siècle}} 8 h {{other}}", "{{open 8 h", deep.replace("{{1er mai}}", "1<sup>er</sup> mai")]
