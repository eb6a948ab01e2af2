"""Main texts of pages with every part that has to go."""

import html as h
import random
import re

import pytest

from mailposture.llm import main_text
from mailposture.llm.queries import op11_main_text

PARTS = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>",
    "<header><div class='logo'>Our site</div><p>The best site there is in all of the world, and then some more.</p></header>",
    "<aside><h3>Popular</h3><p>A long teaser that goes on and on about something else entirely, with many words.</p></aside>",
    "<div class='sidebar'><p>A long teaser that goes on and on about something else entirely, with many words.</p></div>",
    "<div class='cookie-notice'>We use cookies to make this site better for all who come here to read our texts.</div>",
    "<div id='AdSlot' class='ad'>Buy now! This is the very best offer that you will find anywhere in this town today.</div>",
    "<form><label>Mail</label><input name='m'><p>Sign up for the letter that we send out to all readers each week.</p></form>",
    "<script>var t='<p>no</p>';</script><style>p{margin:0}</style><noscript>Switch it on</noscript><!-- note -->",
    "<section id='comments'><h2>Comments</h2><article class='comment'><p>What a great text, I have read it twice and will again.</p></article></section>",
    "<footer><p>&copy; 2020 the makers of this site, with all rights and none of the duties that there may be.</p></footer>",
    "<ul><li><a href='/x'>One</a></li><li><a href='/y'>Two</a></li></ul>",
]
BODY = [("h1", "A <b>title</b> &amp; more"), ("p", "First  text\nof a <a href='/'>link</a>, long enough to stand out from what is around it.<br>Next line."), ("p", "Short."),
        ("blockquote", "Caf&eacute; &#8211; quoted words"), ("p", "Last text, again somewhat longer than the others, so that it counts as content &lt;here&gt;.")]
WANTED = "A title & more\nFirst text of a link, long enough to stand out from what is around it. Next line.\nShort.\nCafé – quoted words\nLast text, again somewhat longer than the others, so that it counts as content <here>."


@pytest.mark.parametrize("wrap", ["article", "main", "div", "section"])
@pytest.mark.parametrize("closed", [True, False])
def test_parts_go_and_all_blocks_stay(wrap, closed):
    for seed in range(20):
        rng = random.Random(seed)
        before, after = rng.sample(PARTS, 4), rng.sample(PARTS, 4)
        blocks = "".join(f"<{t}>{x}</{t}>" if closed or t != "p" else f"<{t}>{x}" for t, x in BODY)
        page = f"<!DOCTYPE html><html><head><title>No</title></head><body>{''.join(before)}<{wrap}>{blocks}</{wrap}>{''.join(after)}</body></html>"
        assert main_text.main_text(page) == WANTED, page


def test_parts_inside_the_article():
    page = "<body><article><header><h1>Title of it</h1><p class='meta'>By me</p></header><p>One two three four five six.</p><div class='ad'>Buy</div><form>x</form><p>Seven.</p><div class='related'><a>More</a></div></article>"
    assert main_text.main_text(page) == "Title of it\nOne two three four five six.\nSeven."


def test_unclosed_parts_before_an_article():
    page = "<body><nav><ul><li><a>Home</a><div class='ad'>Buy<article><p>One two three four five six seven.<p>Eight.</article><footer>End"
    assert main_text.main_text(page) == "One two three four five six seven.\nEight."


def test_awkward_pages(spark):
    long = "<article>" + "".join(f"<p>word {i}</p>" for i in range(20_000)) + "</article>"
    pages = [(1, None), (2, ""), (3, " \n "), (4, "plain &amp; simple"), (5, "<nav>menu</nav>"), (6, "<p>a &am"), (7, long), (7, long), (None, "<p><b>x</p><p>y</i></b>"), (8, "<![x <!-- <"), (9, "<div>" * 5000 + "deep")]
    got = {(r.page_id, r.text) for r in main_text.extract(spark.createDataFrame([(*p, "o") for p in pages], "page_id long, html string, other string")).collect()}
    assert got >= {(1, ""), (2, ""), (3, ""), (4, "plain & simple"), (5, ""), (6, "a &am"), (None, "x\ny"), (9, "deep")}
    assert (7, "\n".join(f"word {i}" for i in range(20_000))) in got
    assert main_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
    with pytest.raises(ValueError):
        main_text.extract(spark.createDataFrame([], "html string, text string"))


def test_query_against_the_article_element(spark, small):
    """The given pages have their text in the article element: taken out here by patterns."""
    got = {r.page_id: (r.text, r.n_chars) for r in op11_main_text(spark, small).collect()}
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n".join(b for b in blocks if b)
        assert got[r.page_id] == (text, len(text))
