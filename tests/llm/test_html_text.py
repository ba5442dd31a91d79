import re
from html.parser import HTMLParser

import pytest
from flowframe.llm.html_text import build, extract, extract_pages

CASES = [
    ("", ""), ("plain   text\nhere", "plain text here"),
    ("<p>a<p>b <b>c</b>d", "a\n\nb cd"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>x<ul><li>y<li>z</ul><li>w</ul>", "- x\n  - y\n  - z\n- w"),
    ("<ol start=3><li>p<li>q</ol>", "3. p\n4. q"),
    ("<table><tr><td>aa<td>b<tr><td>c<th>dddd</table>", "aa | b\nc  | dddd"),
    ("<table><td>1<td>2<tfoot><tr><td>t<td>u</tfoot><tr><td>3<td>4</table>", "1 | 2\n3 | 4\nt | u"),
    ("<table><tr><td colspan=2>wide<tr><td>a<td>b</table>", "wide\na | b"),
    ("<div hidden>no</div><span style='display: none'>no</span><i style='visibility:hidden'>no</i>yes", "yes"),
    ("<script>var x='</p><p>no'</script><style>p{}</style><template>no</template>yes<!-- no --> <![CDATA[too]]>", "yes too"),
    ("x<script>never closed <p>no", "x"), ("x<!-- never closed <p>no", "x"),
    ("<pre>  k\n l</pre>", "  k\n l"), ("<blockquote>q<p>r</blockquote>", "> q\n>\n> r"),
    ("&lt;tag&gt; &eacute;&#233;&#x4e2d; a < b & c", "<tag> éé中 a < b & c"),
    ("</div></p>stray</span>", "stray"), ("<b>bo<i>th</b> on</i>ly", "both only"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<select><option>1<option selected>2</select><details><summary>s</summary>no</details>", "2\ns"),
    ("<img alt='a cat'> sits<hr>on", "a cat sits\n\non"), ("<a title='x > y' href=z>in</a>", "in"),
    ("<h1>T</h1><div>a</div><div>b</div>", "T\n\na\nb"), ("İ<SCRIPT>no</Script>İ", "İİ"),
    ("<div" * 3, ""), ("<" * 50 + "a", "<" * 49), ("<p>" + "\xa0x", "\xa0x"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert extract(page.encode())[1] == text


def test_title_and_bytes():
    assert extract(b"<head><title> A &amp; \n B</title></head><body>x")[0] == "A & B"
    assert extract(b"a\xff\xfe<p>\x00b")[1] == "a��\n\n�b"


def test_very_deep_and_very_long_pages_keep_all_words():
    deep = "<div><ul><li><table><tr><td>" * 3000 + "core" + "</td></tr></table></li></ul></div>" * 3000
    assert "core" in extract(deep.encode())[1]
    words = [f"w{i}" for i in range(60_000)]
    assert extract(("<p>" + "<p>".join(words)).encode())[1].split() == words
    assert extract(("<!--" * 5000 + "'\"" * 5000 + "<a '" * 2000).encode()) == ("", "")


@pytest.mark.parametrize("depth", [10, 150, 199, 200, 201, 250, 5000, 60_000])
def test_hidden_text_stays_hidden_at_any_depth(depth):
    page = "<div hidden>" + "<div>" * depth + "no" + "</div>" * (depth - 20 if depth > 20 else depth) + "neither" + "</div>" * 30 + "shown"
    assert extract(page.encode())[1] == "shown"
    deep = "<section>" * depth + "<p>one<div style='display:none'>no<b>no</b></div><i>two</i>" + "</section>" * depth + "<p>three"
    assert extract(deep.encode())[1].split() == ["one", "two", "three"]


def test_svg_and_math_are_shown():
    page = "a <svg><title>no</title><desc>no</desc><g/><text>label</text></svg> <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b"
    assert extract(page.encode())[1].split() == ["a", "label", "x=2", "b"]


class Walk(HTMLParser):
    """Visible words by the standard library's tokenizer and a stack of names: no tree, no layout."""

    VOID = set("area base br col embed hr img input link meta param source track wbr".split())
    UNSEEN = set("head script style template noscript noframes noembed iframe title datalist audio video canvas object desc metadata defs".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out = [], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "img" and (a.get("alt") or "").strip() and not any(h for _, h in self.open):
            self.out.append(a["alt"])
        if tag not in ("b", "a", "i", "span", "em", "strong"):
            self.out.append(" ")
        if tag not in self.VOID:
            style = re.sub(r"\s", "", a.get("style") or "").lower()
            self.open.append((tag, tag in self.UNSEEN or "hidden" in a or "display:none" in style or "visibility:hidden" in style))

    def handle_endtag(self, tag):
        if tag not in ("b", "a", "i", "span", "em", "strong"):
            self.out.append(" ")
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if not any(h for _, h in self.open):
            self.out.append(data)


def test_words_match_an_independent_parser(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    same = 0
    for page in pages.values():
        walk = Walk()
        walk.feed(page or "")
        walk.close()
        marks = re.compile(r"^(-|\||>|\d+\.)$")
        want = sorted(w for w in "".join(walk.out).split() if not marks.match(w))
        same += sorted(w for w in extract((page or "").encode())[1].split() if not marks.match(w)) == want
    assert same >= 0.98 * len(pages), (same, len(pages))


def test_no_visible_word_is_lost(spark, sf_dir):
    """Against a plain walk of the tree: the same words in the same order."""
    from flowframe.llm.html_text import Node, visible

    def walk(node, out):
        for x in node.children:
            if isinstance(x, str):
                out.append(x)
            elif visible(x):
                walk(x, out)
                out.append(" " if x.name not in ("b", "a", "i", "span", "em", "strong") else "")
        return out

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract_pages(pages).collect():
        want = "".join(walk(build(html[r["page_id"]]), [])).split()
        assert [w for w in r["text"].split() if w != "-"] == [w for w in want if w != "-"]
        assert isinstance(build(html[r["page_id"]]), Node)


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (None, "", "t", None), (1, "<p>a", "t", "x"), (1, "<p>a", "t", "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, title string, text string")
    out = sorted((tuple(r) for r in extract_pages(df).collect()), key=str)
    assert out == sorted([(1, "", ""), (None, "", ""), (1, "", "a"), (1, "", "a")], key=str)
    assert extract_pages(df.where("false")).collect() == []
