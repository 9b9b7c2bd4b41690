"""Hand-labelled layouts, and the given pages against a parser of Python's own."""

from html.parser import HTMLParser

import pytest

from cohortlake.llm import html_extract

STORY = "<h1>Title</h1><p>First paragraph of the story.</p><p>Second one.</p>"
TEXT = "Title\n\nFirst paragraph of the story.\n\nSecond one."

# name: (html of the page, html of its neighbour or None, the text by hand)
LAYOUTS = {
    "sidebar on body": (f'<body class="single-post right-sidebar"><article>{STORY}</article></body>', None, TEXT),
    "no comments on body": (f'<body class="no-comments page"><article>{STORY}</article></body>', None, TEXT),
    "name on article": (f'<article class="post related-none">{STORY}</article>', None, TEXT),
    "header-fixed layout": (f'<div class="header-fixed layout"><article>{STORY}</article></div>', None, TEXT),
    "form round the page": (f'<form id="aspnetForm"><div><article>{STORY}</article></div></form>', None, TEXT),
    "form round an unmarked page": (f'<form id="aspnetForm"><div>{STORY}</div></form>', "<form><div><p>Other.</p></div></form>", TEXT),
    "share price": (f'<article>{STORY}<p class="share-price">Now <b>12</b> EUR.</p></article>', None, TEXT + "\n\nNow 12 EUR."),
    "shared share price": (f'<article>{STORY}<p class="share-price">Follow the price.</p></article>', '<article><p>Else.</p><p class="share-price">Follow the price.</p></article>', TEXT),
    "label in a sentence": ("<article><p>The <label>blue</label> one.</p></article>", None, "The blue one."),
    "teaser outside main": (f"<main><article>{STORY}</article></main><article><h2>Read this too</h2></article>", None, TEXT),
    "teaser in an aside": (f"<article>{STORY}</article><aside><article>Read this too</article></aside>", None, TEXT),
    "side bar by name": (f'<article>{STORY}</article><div class="site-sidebar"><p>Side</p></div>', None, TEXT),
    "comments inside the article": (f'<article>{STORY}<section class="comment-list"><p>Nice!</p></section></article>', None, TEXT),
    "advert inside the article": (f'<article>{STORY}<div class="ad-slot">Buy</div></article>', None, TEXT),
    "header inside the article": ("<article><header><h1>Head</h1></header><p>Body.</p></article>", None, "Head\n\nBody."),
    "form inside the article": (f"<article>{STORY}<form><p>Subscribe</p></form></article>", None, TEXT),
    "hidden part": (f'<article>{STORY}<p style="display: none">Secret</p><p hidden>More</p></article>', None, TEXT),
    "unmarked page and neighbour": (f"<div>Slogan</div><div>{STORY}</div><div>Imprint</div>", "<div>Slogan</div><p>Other</p><div>Imprint</div>", TEXT),
    "unmarked page alone": (f"<nav>Menu</nav><div>{STORY}</div><footer>Foot</footer>", None, TEXT),
    "repeated line in an article": (f"<article>{STORY}</article>", "<article><h1>Title</h1><p>Other.</p></article>", TEXT),
    "article named as page content": (f'<div id="page-header">Top</div><div class="page-content"><article class="entry">{STORY}</article></div>', None, TEXT),
    "raw elements": (f"<article>{STORY}<script>if (a < b) x('</p>')</script><style>p{{}}</style></article>", None, TEXT),
    "references and spaces": ("<article><p>a&nbsp;&amp;\n\t b &#x41;&lt;p&gt;</p></article>", None, "a & b A<p>"),
    "lists and tables": ("<article><ul><li>one<li>two</ul><table><tr><td>a</td><td>b</td></tr></table></article>", None, "one\n\ntwo\n\na b"),
    "role": (f'<div role="navigation">Menu</div><div role="main"><main>{STORY}</main></div>', None, TEXT),
}


def test_layouts(spark):
    rows = []
    for i, (page, neighbour, _) in enumerate(LAYOUTS.values()):
        rows.append((2 * i, f"http://h{i:02d}.org/a", page))
        if neighbour is not None:
            rows.append((2 * i + 1, f"http://h{i:02d}.org/b", neighbour))
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {name: got[2 * i] for i, name in enumerate(LAYOUTS)} == {name: text for name, (_, _, text) in LAYOUTS.items()}


class Article(HTMLParser):
    """The blocks of the article: a stack of tags, nothing of the operator's."""

    ENDS = {"p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "div", "article", "main", "section", "blockquote", "table", "tr", "pre", "figure", "figcaption", "dl", "dt", "dd"}
    GONE = {"script", "style", "nav", "aside", "footer", "form", "noscript", "template", "button", "iframe", "svg"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks, self.text = [], [], ""

    def end(self):
        line = " ".join(self.text.split())
        self.blocks += [line] if line else []
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in self.ENDS:
            self.end()
            if "p" in self.stack and tag != "p" or tag == "p" and "p" in self.stack:
                del self.stack[self.stack.index("p") :]
        if tag == "br":
            self.text += " "
        elif tag not in ("img", "hr", "meta", "link", "input", "wbr"):
            self.stack.append("GONE" if tag in self.GONE or "ad" in dict(attrs).get("class", "").split() or "comments" in str(dict(attrs)) else tag)
            if tag in self.GONE:
                self.stack[-1] = "GONE " + tag

    def handle_endtag(self, tag):
        if tag in self.ENDS or tag in self.GONE:
            self.end()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i] in (tag, "GONE " + tag, "GONE"):
                del self.stack[i:]
                break

    def handle_data(self, data):
        if ("article" in self.stack or "main" in self.stack) and not any(t.startswith("GONE") for t in self.stack):
            self.text += data


def test_given_pages_against_another_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(pages).collect()}
    agree = total = 0
    for r in pages.collect():
        parser = Article()
        parser.feed(r["html"] or "")
        parser.close()
        parser.end()
        total += 1
        agree += got[r["page_id"]] == "\n\n".join(parser.blocks)
    assert agree == total


@pytest.mark.parametrize("name", ["sidebar", "cookie-notice", "site-footer", "nav_links"])
def test_names_that_say_it(name):
    assert html_extract._level("div", f' class="{name}"', False) == html_extract.STRONG


@pytest.mark.parametrize("name", ["share-price", "header-fixed", "no-comments", "related-none"])
def test_names_that_only_hold_a_word(name):
    assert html_extract._level("div", f' class="{name}"', False) == html_extract.WEAK
