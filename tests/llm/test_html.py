"""Layout of small pages; every visible word of the test pages comes out."""

import html as entities
import random
import re
import time
from html.parser import HTMLParser

import pytest
from quern.llm.html import extract, op2_html, render

PAGES = [
    ("<p>a<p>b", "a\n\nb"),
    ("a &amp; b&nbsp;c &lt;x&gt;", "a & b c <x>"),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>t", "- x\n- y\n  - z\n\nt"),
    ("<ol start=9><li>x</li><li>y</li></ol>", "9. x\n10. y"),
    ("<table><tr><th>aa<th>b<tr><td>c<td>dd</table>", "aa | b\nc  | dd"),
    ("<table><tr><td colspan=2>wide</td><td>x</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>", "wide  | x\n1 | 2 | 3"),
    ("<script>var a='<p>no'</script>ok<style>p{}</style><!-- <p>no -->", "ok"),
    ("<div hidden>no</div><div style='color:red; display : none'>no</div><div style='display:nonex'>yes</div>", "yes"),
    ("<span style=visibility:hidden>no</span>yes", "yes"),
    ("<pre>\n a  b\n  c</pre>", " a  b\n  c"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("1 < 2 and <b>bold", "1 < 2 and bold"),
    ("<title>T &amp; t</title><body><h1>H</h1>text", "H\n\ntext"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<img alt='pic'> <input type=hidden value=no><input value=yes>", "pic yes"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<textarea>\nraw <b>x</b></textarea>", "raw <b>x</b>"),
    ("", ""),
    (None, ""),
    ("</p></div>x</table>", "x"),
    ("<table><tr><td><table><tr><td>in</td><td>ner</td></tr></table></td><td>o</td></tr></table>", "in | ner | o"),
    ("<p>a</p>\n\n<p>b</p>\n", "a\n\nb"),
    ("<td>lost</td> cell", "lost\ncell"),
    ("<html><head><title>T</title><p>hello <b>world</b>", "hello world"),
    ("<head><style>no</style>text<title>no</title>", "text"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
    ("<div style='display:none'>no<b style='display:block;visibility:visible'>no</b></div><p hidden style='display:block'>yes", "yes"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td rowspan=2 colspan=2>a b<td>q<tr><td>c<tr><td>1<td>2<td>3</table>", "a b   | q\n  |   | c\n1 | 2 | 3"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a | b\n  | c\n  | d"),
    ("<table><tr><td>one<br>two<td>x<tr><td>y<td>z<br>w</table>", "one | x\ntwo |\ny   | z\n    | w"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<!-->x<!--->y<!-- a --!>z<!-- b", "xyz"),
    ("<a href='x>y</a> z <i title=\"q>w", "y z w"),
    ("a < b <", "a < b <"),
]


@pytest.mark.parametrize("source,want", PAGES)
def test_layout(source, want):
    assert render(source)[1] == want


def test_title():
    assert render("<html><head><title> a\n b </title></head>")[0] == "a b"


class Visible(HTMLParser):
    """All words outside hidden elements, by the standard library's parser."""

    HIDDEN = {"script", "style", "template", "noembed", "noframes", "iframe", "head", "datalist", "noscript", "object", "audio", "video", "canvas", "title"}
    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.words = [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        a = dict(attrs)
        style = re.sub(r"\s", "", (a.get("style") or "").lower())
        self.stack.append((tag, tag in self.HIDDEN or "hidden" in a or "display:none" in style or "visibility:hidden" in style))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(h for _, h in self.stack):
            self.words += data.split()


def test_every_visible_word_of_the_test_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op2_html(spark, sf_dir).collect()
    assert len(got) == len(pages)
    lost = 0
    for r in got:
        parser = Visible()
        parser.feed(pages[r.page_id] or "")
        parser.close()
        text = "".join(r.text.split())
        lost += sum(w not in text for w in parser.words)
        assert "<script" not in entities.unescape(r.text) or "&lt;script" in pages[r.page_id]
    assert lost == 0


def _tree(rng, depth, hidden):
    """(source, visible words in order) of a random tree."""
    source, words = [], []
    for _ in range(rng.randint(1, 4)):
        word = f"w{rng.randrange(10**9)}"
        gone, veiled = hidden
        kind = rng.choice(("text", "div", "p", "span", "ul", "table", "none", "veil", "unveil", "script", "section"))
        if kind == "text" or depth == 0:
            source.append(f" {word} ")
            words += [word] * (not gone and not veiled)
            continue
        if kind == "script":
            source.append(f"<script>if (a<b) '<p>{word}'</script>")
            continue
        inside = {"none": (True, veiled), "veil": (gone, True), "unveil": (gone, False)}.get(kind, hidden)
        body, own = _tree(rng, depth - 1, inside)
        words += own
        if kind == "p":  # a paragraph holds no blocks
            body, extra = f"{word}", [word] * (not gone and not veiled)
            words = words[: len(words) - len(own)] + extra
        shapes = {
            "ul": "<ul><li>{}</ul>", "table": "<table><tr><td>{}</table>", "none": "<div style='display:none'>{}</div>",
            "veil": "<span style='visibility: hidden'>{}</span>", "unveil": "<div style='VISIBILITY:visible !important'>{}</div>",
        }
        source.append(shapes.get(kind, f"<{kind} class='a>b'>{{}}</{kind}>").format(body))
    return "".join(source), words


def test_words_of_random_trees_come_in_order():
    rng = random.Random(7)
    for _ in range(1500):
        source, words = _tree(rng, 4, (False, False))
        assert re.findall(r"w\d+", render(source)[1]) == words, source


@pytest.mark.parametrize("unit", ["<a ", "<div>a", "<p>", "<li>", "<ul><li>a", "<blockquote>a", "<table><tr><td>a", "<td rowspan=9>x", "<td colspan=900>x", "</script ", "<a<", "<dd></dd>", "<x a='", "<a x=\">\" "])
def test_broken_and_deep_pages_take_linear_time(unit):
    """A page four times as long takes about four times as long, not sixteen."""
    took = []
    for size in (40_000, 160_000):
        began = time.process_time()
        out = render("<dl>" + "<div>" * (size // 20) + unit * (size // len(unit)))[1]
        took.append(time.process_time() - began)
        assert len(out) < 40 * size
    assert took[1] < 9 * took[0] + 0.3


def test_columns_and_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>x"), (1, "u", "<p>x"), (None, None, None), (2, "u", "<div>" * 3000 + "deep"), (3, "u", "&#0;&#xD800;&#99999999;z")], "page_id long, url string, html string")
    got = extract(df.selectExpr("*", "1 AS text", "2 AS title")).collect()
    assert sorted(repr((r.page_id, r.title)) for r in got) == sorted(repr((i, "")) for i in (1, 1, None, 2, 3))
    assert [r.text for r in got if r.page_id == 2] == ["deep"]
    assert extract(df.limit(0)).count() == 0
