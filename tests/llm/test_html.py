import pytest
from tokenloom.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="top"><h2>Site name</h2></header><nav><ul><li><a href=1>Home</a></li><li><a href=2>About us</a></li></ul></nav>
<div id="cookie-notice">We use cookies to make this site work better for everyone who reads it</div>
<div class="content"><article><h1>Title &amp; more</h1><p>First <b>bold</b>
   text&nbsp;here &lt;x&gt;.<p>Second, unclosed.<br><p></p><ul><li>item one<li>item two</ul>
<div class="ad">Buy now</div><aside>See also</aside><p>Short.</p><form><input value=x>Sign up</form></article>
<section class="comments"><p>Reader says a long thing about the article, which is not a part of the article at all.</p></section></div>
<div class="sidebar">Popular posts</div><footer>&copy; me</footer>"""


def test_article():
    assert H.main_text(PAGE) == "Title & more\nFirst bold text here <x>.\nSecond, unclosed.\nitem one\nitem two\nShort."
    assert H.main_text(PAGE + "</body></html>") == H.main_text(PAGE)


@pytest.mark.parametrize("outer", ["<main>{}</main>", "<div class='post-body'>{}</div>", "<div><div id=c>{}</div></div>"])
def test_other_containers(outer):
    body = "".join(f"<p>Paragraph {i} has a good many words, as texts have.</p>" for i in range(6)) + "<p>End.</p>"
    page = f"<body class='has-sidebar'><ul><li><a>Home</a></li><li><a>News</a></li></ul>{outer.format(body)}<footer>x</footer>"
    got = H.main_text(page).split("\n")
    assert got == [f"Paragraph {i} has a good many words, as texts have." for i in range(6)] + ["End."]


WORDS = "has a good many words, as the paragraphs of texts have."
MENU = "<ul><li><a>Home</a></li><li><a>News</a></li></ul><div><a>Log in</a> <a>Help</a></div>"


def test_heading_and_lead_outside_the_body_div():
    body = "".join(f"<p>Paragraph {i} {WORDS}</p>" for i in range(12))
    page = (f"<body>{MENU}<div class=post><h1>Title</h1><p>A short lead.</p><div class=body>{body}</div>"
            "<p>The close.</p></div><div class=sidebar><p>Popular</p></div><footer>x</footer>")
    want = ["Title", "A short lead.", *[f"Paragraph {i} {WORDS}" for i in range(12)], "The close."]
    assert H.main_text(page).split("\n") == want


@pytest.mark.parametrize("huge", range(3))
def test_one_huge_section(huge):
    texts = [[f"Section {i} {WORDS}", f"More of {i}."] for i in range(3)]
    texts[huge][0] = "word " * 5000 + "end"
    parts = "".join(f"<section><h2>Part {i}</h2><p>{a}</p><p>{b}</p></section>" for i, (a, b) in enumerate(texts))
    page = f"<body>{MENU}<div class=post>{parts}</div><footer>x</footer>"
    assert H.main_text(page).split("\n") == [x for i, t in enumerate(texts) for x in (f"Part {i}", *t)]


@pytest.mark.parametrize("outer", ["<div>{}</div>", "<main><h1>Both</h1>{}</main>"])
def test_several_articles(outer):
    texts = [[f"Text {i} {k} {WORDS}" for k in range(n)] for i, n in enumerate((6, 4))]
    articles = "".join(f"<article>{''.join(f'<p>{x}</p>' for x in t)}</article>" for t in texts)
    page = f"<body>{MENU}{outer.format(articles)}<footer>x</footer>"
    assert H.main_text(page).split("\n") == ["Both"] * ("h1" in outer) + texts[0] + texts[1]


# Page layouts: wrappers of the article by surroundings, with the blocks that must come out.
BLOCKS = [f"Block {i} {WORDS}" for i in range(8)]
INNER = {
    "bare": "".join(f"<p>{x}</p>" for x in BLOCKS),
    "heading ids": f"<h2 id=related-work>Related work</h2><section id=search-algorithms>{''.join(f'<p>{x}</p>' for x in BLOCKS)}</section>",
    "class names": "".join(f"<p class='share-price lead'>{x}</p>" for x in BLOCKS),
    "inline notices": "".join(f"<p>{x} <span class=notice>skip <span>it</span> all</span>{i}</p>" for i, x in enumerate(BLOCKS)),
    "adverts between": "<div class='google-ad'>Buy</div>".join(f"<p>{x}</p>" for x in BLOCKS),
    "unclosed": "".join(f"<p>{x}" for x in BLOCKS),
}
OUTER = {
    "article": "<body>{m}<article>{t}</article>{e}",
    "unclosed head": "<html><head><meta charset=utf8><title>t</title><script>x</script><body>{m}<div class=post>{t}</div>{e}",
    "no body tag": "<html><head><title>t</title>{m}<div class=post>{t}</div>{e}",
    "page-wide form": "<body><form id=aspnetForm><input type=hidden>{m}<div id=wrap><div id=main>{t}</div></div>{e}</form>",
    "form and article": "<body><form action=x>{m}<article>{t}</article>{e}</form>",
    "layout class": "<body>{m}<div class=content-sidebar-wrap><main>{t}</main><div class=sidebar><p>Popular now</p></div></div>{e}",
    "layout class, divs": "<body>{m}<div class=content-sidebar-wrap><div class=c>{t}</div><div class=sidebar><p>Popular now</p></div></div>{e}",
    "table": "<body>{m}<table><tr><td class=left-nav><a>Home</a><td>{t}</table>{e}",
}
END = ("<section class=reader-comments><h3>Comments</h3><article class='comment even'><p>I have read this with care, and I "
       "don't agree with a single word of it, as I said before.</p></article></section><footer>Legal</footer>")


@pytest.mark.parametrize("outer", OUTER)
@pytest.mark.parametrize("inner", INNER)
def test_layouts(outer, inner):
    page = OUTER[outer].format(m=MENU, t=INNER[inner], e=END)
    want = ["Related work"] * (inner == "heading ids") + [f"{x} {i}" if inner == "inline notices" else x
                                                          for i, x in enumerate(BLOCKS)]
    assert H.main_text(page).split("\n") == want


def test_dropped_inline_elements():
    assert H.main_text("<p>One two <span class=notice>x</span> three.") == "One two three."
    assert H.main_text("<p>One<span class=share>a <span>b</span> LEAK</span> two.<p>Three.") == "One two.\nThree."
    assert H.main_text("<p>One <span class=ad>never closed</p><p>Two.") == "One\nTwo."
    assert H.main_text("<p>It is <a hidden>no <a>link</a></a> here.</p>") == "It is here."


@pytest.mark.parametrize("page", [
    "<form><p>Your name</p><input></form><article><p>A short text.</p></article>",
    "<div class=sidebar><p>A long list of things that have nothing to do with it.</p></div><main><p>A short text.</p></main>",
    "<div id=cookie-notice><p>We use cookies, and say so at a length that no article has.</p></div><p>A short text.</p>",
    "<div hidden><article><p>An older and longer version of this text.</p></article></div><p>A short text.</p>",
])
def test_boilerplate_longer_than_the_text(page):
    assert H.main_text(page) == "A short text."


def test_small_feeds_make_no_difference(monkeypatch):
    whole = H.main_text(PAGE)
    monkeypatch.setattr(H, "FEED", 7)
    assert H.main_text(PAGE) == whole


def test_odd_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p></p>") == ""
    assert H.main_text("just  text") == "just text"
    assert H.main_text("<script>never closed") == ""
    assert H.main_text("</p></div><p>a</i>") == "a"
    assert len(H.main_text("<p>" + "word " * 200_000)) == 999_999
    assert H.main_text("<div>" * 3000 + "deep") == "deep"


def test_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (3, None, "", "x")],
                                  "page_id long, url string, html string, text string")
    got = H.extract_pages(pages).collect()
    assert H.extract_pages(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(str(r.page_id) for r in got) == ["1", "1", "3", "None"]
    assert all(r.n_chars == len(r.text) for r in got)
    assert H.extract_pages(pages.limit(0)).count() == 0
