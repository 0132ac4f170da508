"""HTML extraction against a plain recursive renderer of known trees, and on markup made to be slow or large."""

from __future__ import annotations

import random
import time

import pytest

from shopsight.llm import html

WORDS = [("a", "a"), (" bb ", " bb "), ("c\n  d", "c d"), ("&amp;x", "&x"), ("漢字", "漢字"), (" ", " "), ("x &lt;y", "x <y"), ("1 < 2", "1 < 2")]
BLOCKS = {"div", "p", "ul", "ol", "table"}


def _tree(rng, kinds, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(kinds if depth < 5 else ["text"])
        if kind == "text":
            out.append(("text", rng.choice(WORDS)))
        elif kind in ("p", "b", "gone", "script"):
            out.append((kind, _tree(rng, ["text", "b", "gone"], depth + 1)))
        elif kind == "div":
            out.append((kind, _tree(rng, kinds, depth + 1)))
        elif kind in ("ul", "ol"):
            out.append((kind, [_tree(rng, kinds, depth + 1) for _ in range(rng.randint(1, 3))]))
        else:
            out.append((kind, [[_tree(rng, kinds, depth + 1) for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 3))]))
    return out


def _markup(rng, nodes):
    out = ""
    for at, (kind, inside) in enumerate(nodes):
        follows = nodes[at + 1][0] if at + 1 < len(nodes) else None
        if kind == "text":
            out += inside[0]
        elif kind == "gone":
            out += rng.choice(["<span hidden>", "<span style='color:red; display : none'>", "<SPAN STYLE=display:none>"]) + _markup(rng, inside) + "</span>"
        elif kind == "script":
            out += "<script>if (a<b) '</p><li>'</Script >"
        elif kind == "p":
            out += "<p class=x>" + _markup(rng, inside) + ("" if (follows is None or follows in BLOCKS) and rng.random() < 0.5 else "</p>")
        elif kind in ("ul", "ol"):
            out += f"<{kind}>" + "".join("<li>" + _markup(rng, x) + rng.choice(["", "</li>"]) for x in inside) + f"</{kind}>"
        elif kind == "table":
            rows = ["<tr>" + "".join("<td>" + _markup(rng, c) + rng.choice(["", "</td>"]) for c in row) + rng.choice(["", "</tr>"]) for row in inside]
            out += "<table>" + rng.choice(["", "<tbody>"]) + "".join(rows) + "</table>"
        else:
            out += f"<{kind}>" + _markup(rng, inside) + f"</{kind}>"
        if kind != "text" and rng.random() < 0.2 and (kind != "p" or out.endswith("</p>")):
            out += rng.choice(["<!-- <p> -->", "</i>", "<!doctype x>"])
    return out


def _items(nodes, depth):
    """Pieces of text, requests for a break (1) or a blank line (2), markers of list items."""
    for kind, inside in nodes:
        if kind == "text":
            yield "text", inside[1], depth
        elif kind == "b":
            yield from _items(inside, depth)
        elif kind in ("div", "p"):
            gap = 1 if kind == "div" else 2
            yield "gap", gap, depth
            yield from _items(inside, depth)
            yield "gap", gap, depth
        elif kind in ("ul", "ol"):
            yield "gap", 1 if depth else 2, depth
            for i, item in enumerate(inside):
                yield "gap", 1, depth
                yield "lead", f"{i + 1}. " if kind == "ol" else "- ", depth
                yield from _items(item, depth + 1)
                yield "gap", 1, depth
                yield "lead", "", depth
            yield "gap", 1 if depth else 2, depth
        elif kind == "table":
            yield "gap", 2, depth
            rows = [[_plain(c, depth) for c in row] for row in inside]
            wide = [max(html.width_of(line) for row in rows if x < len(row) for line in row[x] + [""]) for x in range(max(map(len, rows)))]
            for row in rows:
                for y in range(max(map(len, row))):
                    cells = [c[y] if y < len(c) else "" for c in row]
                    line = "  ".join(c + " " * (w - html.width_of(c)) for c, w in zip(cells, wide)).rstrip()
                    if line:
                        yield "line", line, depth
                        yield "gap", 1, depth
            yield "gap", 2, depth


def _plain(nodes, depth=0):
    lines, line, gap, lead = [], "", 0, ""
    for kind, value, level in [*_items(nodes, depth), ("gap", 0, 0)]:
        if kind == "gap":
            if line.strip():
                lines.append(line.rstrip())
                gap = 0
            line, gap = "", max(gap, value)
        elif kind == "lead":
            lead = value
        else:
            text = value.lstrip(" ") if kind == "text" and (not line or line[-1] == " ") else value
            if text and not line:
                lines += [""] * (gap == 2 and bool(lines))
                line, gap, lead = "  " * max(0, level - 1) + lead, 0, ""
            line += text
    return lines


def test_random_markup(monkeypatch):
    monkeypatch.setattr(html, "ROOM", 1000)  # small pages may need more blanks than the bound grants
    rng = random.Random(11)
    for _ in range(3000):
        tree = _tree(rng, ["text", "text", "b", "gone", "script", "div", "p", "ul", "ol", "table"])
        page = _markup(rng, tree)
        assert html.render(page) == "\n".join(_plain(tree)), page


def test_layout():
    assert html.render("a<br><br>b<br>c") == "a\n\nb\nc"
    assert html.render("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a  b\n   c\nd  e"
    assert html.render("<table><tr><td colspan=2>long head<tr><td>a<td>b</table>") == "long head\na  b"
    assert html.render("<table><tr><td><p>one<p>two<td><ul><li>x<li>y</ul></table>") == "one  - x\n     - y\ntwo"
    assert html.render("<td>one<td>two") == "one two"
    assert html.render("<table><tr><td>漢字<td>x<tr><td>a<td>y</table>") == "漢字  x\na     y"
    assert html.render("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>") == "yes"
    assert html.render("<ol><li>a<li value=7>b<li>c</ol>") == "1. a\n7. b\n8. c"
    assert html.render("x <select><option>a<option selected>b</select> y<select multiple><option>c<option>d</select>") == "x b y\nc\nd"
    assert html.render("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    assert html.render("<details>no<summary>s</summary><p>no</details><details open><summary>t</summary>u</details>") == "s\nt\nu"
    assert html.render("<b><table><tr><td>x</b>y<td>z</table>") == "xy  z"
    assert html.render("<pre>\n a\n\n  b</pre>c") == " a\n\n  b\n\nc"
    assert html.render("<textarea>a <b>&lt;</textarea>") == "a <b><"
    assert html.render("a<!-- b") == html.render("a<b c='d>e") == "a"


LONG = {
    "open tags": "<a " * 350_000,
    "open quotes": '<a b="' * 150_000,
    "open comments": "<!--" * 250_000,
    "blanks in a tag": "<a" + " " * 1_000_000,
    "signs": "<" * 1_000_000,
    "a large number": "&#" + "9" * 1_000_000 + ";",
    "zeros": "&#x" + "0" * 1_000_000 + "41;",
    "one large cell": "<table><tr><td>" + "x" * 20_000 + "<td>y" + "<tr><td>a<td>b" * 70_000 + "</table>",
    "cells that reach down": "<table><tr>" + "<td rowspan=9999>x" * 30_000 + "<tr><td>x" * 30_000,
    "far cells": "<table><tr>" + "<td>xxxx" * 10_000 + ("<tr>" + "<td>" * 3_000 + "z") * 15,
    "nested lists": "<ul><li>x" * 100_000,
    "nested tables": "<table><tr><td>x<td>y" * 50_000,
    "inline pieces": "<b>x</b>" * 130_000,
    "closed details": "<details>" * 100_000,
    "nested choices": "<select><option>x" * 60_000,
}


@pytest.mark.parametrize("name", LONG)
def test_long_broken_pages(name):
    """About a megabyte each: seconds, and no more text than the bounds allow."""
    page = LONG[name]
    begun = time.process_time()
    text = html.render(page)
    assert time.process_time() - begun < 20
    assert len(text) <= (1 + html.ROOM) * len(page) + 2 * html.DEEP * len(page) // 9
    if name in ("a large number", "zeros"):
        assert text == ("�" if name == "a large number" else "A")
    if name == "one large cell":
        assert text.count("x") == 20_000 and text.count("b") == 70_000
    if name == "far cells":
        assert text.count("z") == 15
