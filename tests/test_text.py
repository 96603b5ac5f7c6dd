"""Text operators against brute force in plain Python, on random small texts."""

import html.entities
import random

import pytest

from wikiloom.config import ENGLISH_NAMESPACES, Options
from wikiloom.functions import lines as N
from wikiloom.functions import links as L
from wikiloom.functions import markup as M
from wikiloom.functions import nesting as B


def random_texts(pieces, n=1500, size=14, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, size))) for _ in range(n)]


# --- nested blocks ---------------------------------------------------------

def drop_by_stack(text, opening, closing):
    out, start, depth, i = [], 0, 0, 0
    while i < len(text):
        two = text[i:i + 2]
        if two == opening:
            if depth == 0:
                start = i
            depth, i = depth + 1, i + 2
        elif two == closing:
            if depth == 0:
                out.append(two)
            depth, i = max(depth - 1, 0), i + 2
        else:
            if depth == 0:
                out.append(text[i])
            i += 1
    return "".join(out) + (text[start:] if depth else "")


@pytest.mark.parametrize("depth", [1, 2, 8])
def test_templates(evaluate, depth):
    texts = random_texts(["{{", "}}", "{", "}", "a", "b|", "\n", "{{x}}"]) + [
        "a {{b {{c}} d}} e {{f}} g {{{h}}} i", "x {{a y", "x }} y", "{{" * 20 + "z" + "}}" * 20 + "end"]
    got = evaluate(lambda t: B.drop_templates(t, depth), texts)
    assert got == [drop_by_stack(t, "{{", "}}") for t in texts]


@pytest.mark.parametrize("depth", [1, 8])
def test_tables(evaluate, depth):
    texts = random_texts(["{|", "|}", "{", "}", "|", "a", "\n|-\n", "{|x|}"])
    assert evaluate(lambda t: B.drop_tables(t, depth), texts) == [drop_by_stack(t, "{|", "|}") for t in texts]


def test_templates_of_any_size(evaluate):
    balanced = "word {{a|{{b}}|c}} " * 20000
    unclosed = "{{open " + "x {{a}} " * 20000
    deep = "p " + "{{" * 3000 + "q" + "}}" * 3000 + " r"
    assert evaluate(B.drop_templates, [balanced, unclosed, deep]) == ["word  " * 20000, unclosed, "p  r"]


# --- texts built from pieces whose outcome is known --------------------------

def built(pairs, between=" ~ ", n=400, size=8, seed=5):
    """Random rows of pieces, and what must become of them."""
    rng = random.Random(seed)
    rows = [[rng.choice(pairs) for _ in range(rng.randint(1, size))] for _ in range(n)]
    return [between.join(p[0] for p in row) for row in rows], [between.join(p[1] for p in row) for row in rows]


def same(evaluate, step, pairs, **how):
    texts, expected = built(pairs, **how)
    assert evaluate(step, texts) == expected


@pytest.mark.parametrize("namespaces", [(), ENGLISH_NAMESPACES])
@pytest.mark.parametrize("keep", [True, False])
def test_links(evaluate, namespaces, keep):
    def shown(target, label):
        return f'<a href="{target}">{label}</a>' if keep else label

    hidden = "" if namespaces else shown("File:ofen.png", "warm")
    same(evaluate, lambda t: L.links_to_anchors(t, namespaces, keep), [
        ("[[Ofen]]", shown("Ofen", "Ofen")), ("[[Ofen|Herd]]", shown("Ofen", "Herd")), ("[[Ofen|Herd]]e", shown("Ofen", "Herde")),
        ("[[Ofen]]s", shown("Ofen", "Ofens")), ("[[Ofen|]]", shown("Ofen", "Ofen")), ("[[Unknown:Ofen]]", shown("Unknown:Ofen", "Unknown:Ofen")),
        ("[[File:ofen.png|warm]]", hidden), ("[[Ofen", "[[Ofen")], between="\n")


def test_external_links(evaluate):
    same(evaluate, L.external_link_labels, [("[http://kiln.test/a the kiln]", "the kiln"), ("[kiln]", "[kiln]"), ("kiln", "kiln")], between="\n")
    same(evaluate, L.drop_bracketed_word, [("[kiln]", ""), ("[two words]", "[two words]"), ("[kiln&]", ""), ("[", "[")], between="\n")
    same(evaluate, L.drop_leftover_links, [("[[a [b]]", ""), ("[[x]]", ""), ("plain", "plain")], between="\n")


def test_quotes(evaluate):
    same(evaluate, M.quotes, [
        ("'''''clay'''''", "<i>clay</i>"), ("'''clay'''", "<b>clay</b>"), ("''clay''", "<i>clay</i> "),
        ("''\"clay\"''", "&quot;clay&quot;"), ('""clay""', "clay"), ("it's", "it's"), ('"clay"', '"clay"')], between="\n")


def test_entities(evaluate):
    names = [(f"&{name};", chr(code)) for name, code in html.entities.name2codepoint.items()]
    same(evaluate, M.unescape_once, names + [
        ("&#233;", "é"), ("&#x1F600;", "\U0001F600"), ("&#0065;", "A"), ("&#xD800;", "&#xD800;"), ("&#1114112;", "&#1114112;"),
        ("&nosuch;", "&nosuch;"), ("&#;", "&#;"), ("& amp;", "& amp;"), ("&amp;lt;", "&lt;")], n=1500)
    assert evaluate(M.unescape_entities, ["&amp;lt; &amp;amp;lt;"]) == ["< &lt;"]


def test_tags(evaluate):
    same(evaluate, M.drop_comments, [("<!-- a > b -->", ""), ("<!---->", ""), ("<b>", "<b>"), ("-->", "-->"), ("<!--\nx\n-->", "")])
    tag, other = Options().self_closing_tags[0], Options().ignored_tags[0]
    same(evaluate, M.drop_self_closing, [(f"<{tag}/>", ""), (f"< {tag.upper()} name=a / >", ""), (f"<{tag}x/>", f"<{tag}x/>"), ("a/b", "a/b")])
    same(evaluate, M.unwrap_ignored_tags, [(f"<{other}>in</{other}>", "in"), (f"< {other.upper()} style=x>in< / {other}>", "in"),
                                           (f"<{other}x>", f"<{other}x>"), ("1 < 2", "1 < 2")])


def test_elements(evaluate):
    for tag in Options().discard_elements:
        same(evaluate, M.drop_elements, [(f"<{tag}>x\ny</{tag}>", ""), (f"<{tag.upper()} a=1>x< / {tag} >".replace(" >", ">"), ""),
                                         ("kept", "kept"), (f"<{tag}x>", f"<{tag}x>")], n=60)


def test_placeholders(evaluate):
    text = "a <code>one</code> b < CODE x=1 >two</ code > c <code>one</code> d <codex>three</codex>"
    assert evaluate(M.placeholders, [text, "<code>open", ""]) == [
        "a codice_1 b codice_2 c codice_1 d <codex>three</codex>", "<code>open", ""]


def test_tidy(evaluate):
    same(evaluate, M.tidy, [("a   b", "a b"), ("a\tb", "a b"), ("wait.....", "wait..."), ("a...b", "a...b"), ("x,,y", "x,y"),
                            ("x,.", "x."), ("one\n-.-\ntwo", "one\ntwo")], between=" ~ ")


@pytest.mark.parametrize("sections", [True, False])
def test_compact(evaluate, sections):
    options = Options(keep_sections=sections)
    pairs = [("== Glaze ==", "<h2>Glaze</h2>" if sections else ""), ("", "<br/><br/>"), ("++Kilns++", "Kilns."), ("++Hot!++", "Hot!"),
             ("++++", ""), ("* item", "* item"), ("{ residue", ""), ("| cell", ""), ("left }", ""), ("(aside)", ""), (".-.", ""),
             ("--\r", "--\r"), ("--\u2028", "--\u2028"), ("plain = text", "plain = text")]
    texts, _ = built(pairs, between="\n")
    outcome = dict(pairs)
    assert evaluate(lambda t: N.compact_to_html(t, options), texts) == [
        "".join(outcome[line] for line in t.split("\n")) for t in texts]


def test_nested_lists(evaluate):
    text = "* clay\n** red\n** white\n* glaze\n\nend"
    assert evaluate(lambda t: N.compact_to_html(t, Options(lists="html")), [text]) == [
        "<ul><li> clay</li><ul><li> red</li><li> white</li></ul><li> glaze</li></ul><br/><br/>end"]


def test_breaks_and_math(evaluate):
    def step(text):
        return M.math_delimiters(M.cap_breaks(text))

    same(evaluate, step, [("<br/>" * n, "<br/>" * min(n, 2)) for n in range(1, 7)] + [("<math>x^2</math>", "\\(x^2\\)"), ("x", "x")])


def test_many_template_arguments(evaluate):
    """Long argument lists need no stack."""
    from wikiloom.functions import french as fr

    many = "|a" * 100_000
    assert evaluate(fr.lang, ["{{lang|la" + many + "}}"])[0] is not None
    for rule, text in ((fr.unit, "{{unité|1" + many + "}}"), (fr.hour, "{{heure" + "|11" * 100_000 + "}}"),
                       (fr.century, "{{s" + "|V|e" * 100_000 + "}}")):
        assert not evaluate(rule, [text])[0].startswith("{{")


@pytest.mark.parametrize("unit", ["<ref> word <ul> ", "<div ", "<!-- word ", "[word word [http://x y ", "[[a|", "{{open word ",
                                  "{| a ", "<li> word ", "== word ", "<code> word ",
                                  "<code ", "< code x> <code", "{{nobr|a ", "{{citation|word ", "{{unité|1|km "])
def test_openings_without_end(evaluate, unit):
    """Large pages full of openings that nothing closes: no step may search them again and again."""
    text = unit * 20000
    from wikiloom.functions.french import translate_fr

    steps = [B.drop_templates, B.drop_tables, L.links_to_anchors, L.drop_leftover_links, L.external_link_labels,
             M.drop_comments, M.drop_self_closing, M.unwrap_ignored_tags, M.drop_elements, M.placeholders, translate_fr]
    for step in steps:
        assert evaluate(step, [text]) == [text]
