import re
import time

import pytest

from sessile.llm.html_text import MOST_INDENT, extract_text, visible_text

CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<title>t</title><h1>Head</h1>text<br>next", "Head\n\ntext\nnext"),
    ("a<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> -->b", "ab"),
    ("<div hidden>no</div><div style='display: none'>no</div><span style=\"visibility:hidden\">no</span><div>yes</div>", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul><ol><li>x<li>y</ol>", "- a\n- b\n  - c\n\n1. x\n2. y"),
    ("<table><tr><th>name<th>n<tr><td>ab<td>1<tr><td>abcdef<td>22</table>", "name   | n\nab     | 1\nabcdef | 22"),
    ("<table><caption>cap</caption><tr><td colspan=2>wide</td><td>z<tr><td>a<td>b<td>c</table>", "cap\nwide  | z\na | b | c"),
    ("<pre>  keep\n   this</pre>after", "  keep\n   this\n\nafter"),
    ("&lt;b&gt; &amp; &eacute;&#x41;", "<b> & éA"),
    ("<details><summary>s</summary>closed</details><details open><summary>t</summary>open</details>", "s\nt\nopen"),
    ("<dl><dt>k<dd>v<dt>k2<dd>v2</dl>", "k\n  v\nk2\n  v2"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("a < b and <3 <unclosed", "a < b and <3 <unclosed"),
    ("<b>bold</p><i>x</b>y</i>z", "bold\n\nxyz"),
    ('<a title="x>y" href=z>link</a>', "link"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<head><title>x</title><body><p>y", "y"),
    ("<textarea>a\n<b></textarea>", "a <b>"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>x<td rowspan=2>mid<td>y<tr><td>longer<td>z<tr><td>1<td>2<td>3</table>", "x      | mid | y\nlonger |     | z\n1      | 2   | 3"),
    ("<table><tr><td colspan=2000>wide<td>z<tr><td>a<td>b</table>", "wide  | z\na | b"),
    ("<table><tr><td rowspan=0>all<td>1<tr><td>2<tr><td>3</table>", "all | 1\n    | 2\n    | 3"),
    ("<div style='visibility:hidden'>no<span style='visibility: visible'>yes</span>no</div>", "yes"),
    ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
    ("<div style='display:none'>no<span style='visibility:visible'>no</span></div>x", "x"),
    ("<table>note<tr><td>a</table>", "note\n\na"),
    ("<table><p>note</p><tr><td>a</table>", "note\n\na"),
    ("<table><tr>note<td>a</table>", "note\n\na"),
    ("<table><tr><form><td>content</form></table>", "content"),
    ("<table><div>x<tr><td>a</table>", "x\n\na"),
    ("<svg><title>t</title><text>seen</text></svg><math><mi>x</mi><annotation>no</annotation></math>", "seen\nx"),
    ('<a href="x>not closed <b>bold</b>', "not closed bold"),
    ("<a title='it\\'s'>y</a>z", "yz"),
]


@pytest.mark.parametrize(("source", "text"), CASES)
def test_layout(source, text):
    assert visible_text(source) == text


def test_depth_and_length_are_no_limit():
    assert visible_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert visible_text("<ul><li>" * 300 + "x").endswith("x")
    long = "<p>" + "word " * 200_000 + "</p>"
    assert visible_text(long).count("word") == 200_000


@pytest.mark.parametrize("piece", ["<a ", "<a", "<a x=\"", "<a x=''", "<a x=\">\"", "<a x='>' ", "</a", "<!-", "<div>", "<ul><li>", "<table><tr><td>", "<p><b>", "&amp;", "<td rowspan=9 colspan=900>x", "</b></i>", "<table>x"])
def test_a_hundred_thousand_pieces_take_no_time(piece):
    import time

    start = time.perf_counter()
    visible_text(piece * (5_000 if piece.startswith(("<ul", "<table><tr", "<td", "<table>x")) else 50_000))
    assert time.perf_counter() - start < 12


def made(rng, depth=0):
    """A random block as HTML and, said on its own, its lines; None for a margin."""
    word = lambda: rng.choice("alpha beta gamma delta &amp; x&lt;y".split())
    plain = lambda t: t.replace("&amp;", "&").replace("&lt;", "<")

    def inline():
        words = [word() for _ in range(rng.randint(1, 4))]
        markup = [rng.choice(["{}", "<b>{}</b>", "<i title='a>b'>{}", "<span hidden>no</span>{}", "<!-- > -->{}", "<span style='visibility:hidden'>no</span>{}"]).format(w) for w in words]
        return rng.choice([" ", "\n ", "  "]).join(markup), plain(" ".join(words))

    kind = rng.choice(["p", "div", "ul", "ol", "table", "pre", "none", "quote"] if depth < 3 else ["p", "div"])
    if kind == "p":
        markup, text = inline()
        return f"<p>{markup}" + rng.choice(["</p>", ""]), [None, text, None]
    if kind == "div":
        markup, text = inline()
        return f"<div>{markup}</div>", [text]
    if kind == "none":
        return f"<div style='display:none'>{made(rng, depth + 1)[0]}</div>", []
    if kind == "pre":
        return "<pre>  a\n    b</pre>", [None, "  a", "    b", None]
    if kind == "quote":
        markup, lines = made(rng, depth + 1)
        return f"<blockquote>{markup}</blockquote>", [None, *("  " + x if x else x for x in settled(lines)), None]
    if kind in ("ul", "ol"):
        items, out = [], [None]
        for k in range(rng.randint(1, 3)):
            markup, text = inline()
            inner = ("", [])
            if rng.random() < 0.4 and depth < 2:
                m, t = inline()
                inner = (f"<ul><li>{m}</ul>", ["- " + t])
            items.append(f"<li>{markup}{inner[0]}" + rng.choice(["</li>", ""]))
            mark = f"{k + 1}. " if kind == "ol" else "- "
            out += [mark + text, *(" " * len(mark) + x for x in inner[1])]
        return f"<{kind}>{''.join(items)}</{kind}>", [*out, None]
    n, rows, markup = rng.randint(1, 3), [], ""
    for _ in range(rng.randint(1, 3)):
        cells = [inline() for _ in range(n)]
        markup += "<tr>" + "".join(f"<td>{m}" + rng.choice(["</td>", ""]) for m, _ in cells)
        rows.append([t for _, t in cells])
    widths = [max(len(r[c]) for r in rows) for c in range(n)]
    return f"<table>{markup}</table>", [None, *(" | ".join(t.ljust(w) for t, w in zip(r, widths, strict=True)).rstrip() for r in rows), None]


def settled(lines):
    """Lines with each run of margins between two of them as one blank line."""
    out, due = [], False
    for x in lines:
        if x is None:
            due = bool(out)
        else:
            out += [""] * due + [x]
            due = False
    return out


def test_random_pages_match_a_plain_renderer():
    import random

    for seed in range(400):
        rng = random.Random(seed)
        parts = [made(rng) for _ in range(rng.randint(1, 6))]
        # A paragraph left open ends where the next block begins.
        assert visible_text("".join(m for m, _ in parts)) == "\n".join(settled([x for _, lines in parts for x in lines])), (seed, "".join(m for m, _ in parts))


def test_no_visible_word_is_lost(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    texts = {r.page_id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        import html

        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>|<style.*?</style>|<title.*?</title>", "", r.html)
        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert [w for w in texts[r.page_id].split() if w != "-"] == [w for w in words if w != "-"]


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "u"), (None, "<p>x", None), (1, "<p>x", "u")], "page_id long, html string, text string")
    assert sorted(map(repr, extract_text(df).collect())) == sorted(["Row(page_id=1, text='')", "Row(page_id=None, text='x')", "Row(page_id=1, text='x')"])
    assert extract_text(df.filter("false")).collect() == []


@pytest.mark.parametrize(
    "page",
    ["<ul><li>x" * 5000, "<ul><li>" * 5000 + "x", "<blockquote>x" * 5000, "<li>" + "<span>" * 4000 + "<dt>" * 4000, "<div>" * 12000 + "<table>" + "x<b>y</b>" * 12000, "<i><div>" + "<span>" * 5000 + "</i>" * 5000],
    ids=["lists", "marks", "quotations", "terms", "stray", "ends"],
)
def test_hostile_pages_take_no_longer_than_their_size(page):
    start = time.perf_counter()
    text = visible_text(page)
    assert time.perf_counter() - start < 2
    assert text.count("x") == page.count("x") and max(map(len, text.split("\n"))) <= 2 * 5000 + 24000


def test_indent_has_a_limit():
    lines = visible_text("<blockquote>x" * 300).split("\n")
    assert [len(x) - 1 for x in lines if x] == [min(2 * k, MOST_INDENT) for k in range(1, 301)]
