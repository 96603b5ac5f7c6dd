"""Templates at any depth against a recursive parser."""

import random

from pyspark.sql import functions as F

from wikiloom.config import Options, standard_languages
from wikiloom.functions import french as fr
from wikiloom.functions.convert import clean, translate
from wikiloom.functions.templates import nesting_height, rewrite_templates

RULES = [fr.nobr, fr.small_numbers, fr.who_what, fr.japanese]


def by_hand(text):
    """Pairs brackets from left to right and replaces what is closed, inner templates first."""
    frames, i = [""], 0
    while i < len(text):
        if text.startswith("{{", i):
            frames.append("")
            i += 2
        elif text.startswith("}}", i) and len(frames) > 1:
            body = frames.pop()
            frames[-1] += rule(body)
            i += 2
        else:
            frames[-1] += text[i]
            i += 1
    out = frames[0]
    for open_ in frames[1:]:
        out += "{{" + open_
    return out.replace("\x02", "{{").replace("\x03", "}}").replace("\x04", "|")


def rule(body):
    name, *args = body.split("|")
    rest = "|".join(args)
    if name.lower() == "nobr" and rest:
        return f'<span class="nowrap">{rest}</span>'
    if name == "exp" and rest:
        return f"<sup>{rest}</sup>"
    if name.lower() == "qui" and len(args) == 1 and rest:
        return rest
    if name.lower() == "japonais" and len(args) > 1 and args[0] and ", ".join(args[1:]):
        return f"{args[0]} ({', '.join(args[1:])})"
    return "\x02" + body.replace("|", "\x04") + "\x03"


def test_random_nesting(evaluate):
    rng = random.Random(3)
    parts = ["{{nobr|", "{{exp|", "{{qui|", "{{japonais|", "{{box|", "{{", "}}", "}}", "}}", "}}", "|", "a", "é b", "\n", "{", "}", "[[x|y]]"]
    # single braces next to others are read in tokens of two from the left; keep them apart here
    texts = []
    for _ in range(1500):
        text = ""
        for part in rng.choices(parts, k=rng.randint(1, 30)):
            text += (" " if text[-1:] in ("{", "}") and part[:1] == text[-1:] else "") + part
        texts.append(text)
    assert evaluate(lambda t: rewrite_templates(t, RULES), texts) == [by_hand(t) for t in texts]


def test_any_depth(evaluate):
    inner = "{{heure|8}}"
    for depth in (2, 12, 60):
        text = "{{nobr|" * depth + inner + "}}" * depth
        assert evaluate(fr.translate_fr, [text, "{{open " * 300 + text]) == [
            '<span class="nowrap">' * depth + "8 h" + "</span>" * depth,
            "{{open " * 300 + '<span class="nowrap">' * depth + "8 h" + "</span>" * depth]
    page = "a " + "{{nobr|" * 12 + "x" + "}}" * 12 + "{{box|" * 12 + "}}" * 12
    assert evaluate(lambda t: clean(t, F.lit("fr")), [page]) == ["a " + '<span class="nowrap">' * 12 + "x" + "</span>" * 12]


def test_height(evaluate):
    texts = ["", "x", "{{", "}}", "{{}}", "{{a{{b}}}}", "{{" * 9 + "{{a}}{{b}}", "}}{{a}}{{b{{c{{d}}}}}}", "{{a{{b}}{{c{{d}}"]
    assert evaluate(nesting_height, texts) == [0, 0, 0, 0, 1, 2, 1, 3, 1]


def test_optional_rule_sets(evaluate):
    french = standard_languages().choose("wikipedia", "fr")
    texts = ["{{rouge|x}} {{pas clair|y}} {{heure|8}}"]
    sets = [(), ("notes",), ("notes", "colours"), ("unknown",)]
    got = [evaluate(lambda t: translate(t, french, names), texts)[0] for names in sets]
    assert got == ["x {{pas clair|y}} 8 h", "x y<sup>[pas clair]</sup> 8 h",
                   "<font color='red'>x</font> y<sup>[pas clair]</sup> 8 h", "x {{pas clair|y}} 8 h"]
    cleaned = evaluate(lambda t: clean(t, F.lit("fr"), options=Options(rule_sets=("notes",))), texts)[0]
    assert cleaned == "x y<sup>clair</sup> 8 h"  # the label of a bracketed link, as everywhere
