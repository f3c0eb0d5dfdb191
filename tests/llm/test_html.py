import html
import re
import tracemalloc

import pytest

from dayledger.llm.html_text import extracted, main_text, parsed

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:1}</style><script>if (a<b) track("</p>");</script></head>
<body class="has-sidebar"><div class="cookie-notice">We use cookies, really.</div><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav>
<div id="sidebar"><p>Latest posts, and more of them.</p></div>
<div class="post-content"><h2>A  heading</h2><p>First &amp; longest paragraph,\n with words. It goes on, and on.
<p>Second one&#39;s text, <b>bold</b> and <a href="x">linked</a>. Here it ends.<ul><li>one<li>two</ul>
<form><input value=q><label>Search</label></form><div class="ad">Buy now!</div><p>5 < 6, third<br>line.</div>
<section class="comments"><p>Nice article, thank you so much. I read it twice, and liked it.</p></section>
<footer>&copy; me</footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(PAGE).split("\n\n") == [
        "A heading", "First & longest paragraph, with words. It goes on, and on.",
        "Second one's text, bold and linked. Here it ends.", "one", "two", "5 < 6, third line.",
    ]


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<!-- open", "<script>x", "<nav>only links</nav>"])
def test_pages_without_content(page):
    assert main_text(page) == ""


def test_cut_off_and_plain_pages():
    assert main_text("just text, no markup") == "just text, no markup"
    assert main_text("<article><h1>T</h1><p>Some text, here.<p class='x") == "T\n\nSome text, here."
    assert main_text("<ARTICLE><P>Upper, case.</P></ARTICLE>") == "Upper, case."
    assert main_text("<article><header><h1>T</h1></header><p>Body, text.</p></article>") == "Body, text."


def test_long_pages_are_read_whole():
    paragraphs = [f"Paragraph {n}, with some words." for n in range(5000)]
    page = "<body><main>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</main></body>"
    assert main_text(page) == "\n\n".join(paragraphs)
    assert len(parsed("<div>" * 3000 + "deep, text" + "</div>" * 3000).blocks) == 1


def test_deep_pages_take_memory_in_proportion():
    peaks = []
    for depth in (2000, 8000):
        page = "".join(f"<div>Text {n}, here." for n in range(depth))
        tracemalloc.start()
        assert len(parsed(page).blocks) == depth and f"Text {depth - 1}, here." in main_text(page)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 6 * peaks[0]


LONG = [f"Paragraph {n} of the story, with a number of words, and marks. It goes on, as stories do." for n in range(20)]
TEASER = "<article><h3>Other story</h3><p>A teaser, with one sentence for it.</p></article>"


@pytest.mark.parametrize("wrapped", ["{}", "<form action=x><input value=q>{}</form>", "<main>{}</main>"])
def test_a_teaser_does_not_replace_the_story(wrapped):
    story = "<div class=body>" + "".join(f"<p>{p}</p>" for p in LONG) + "</div>"
    page = f"<body><div id=top>Site</div>{wrapped.format(story)}<div class=more>{TEASER}</div></body>"
    assert main_text(page) == "\n\n".join(LONG)


def test_several_articles_are_one_page_of_text():
    page = "<body><div>" + "".join(f"<article><p>{p}</p></article>" for p in LONG) + "</div></body>"
    assert main_text(page) == "\n\n".join(LONG)


def test_a_form_inside_the_article_is_left_out():
    page = f"<article><p>{LONG[0]}</p><form>Write to us, please. <input><p>Terms, and so on.</p></form><p>{LONG[1]}</p></article>"
    assert main_text(page) == f"{LONG[0]}\n\n{LONG[1]}"


def test_given_pages(spark, sf_dir):
    """In these pages the article element holds the article and nothing else."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    htmls = {r.page_id: r.html for r in pages.collect()}
    got = extracted(pages).collect()
    assert len(got) == len(htmls)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", htmls[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_edge_rows(spark):
    rows = [(1, None, None), (None, "u", PAGE), (1, None, None), (2, "", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = extracted(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 0, len(main_text(PAGE))]
    assert extracted(pages.where("false")).collect() == []
