import html
import re

import pytest
from pyspark.sql import functions as F

from tidemart.llm import html_extract, queries
from tidemart.llm.html_blocks import text_blocks

TREE = html_extract.trained_tree()


def main(source):
    return html_extract.main_text(source, TREE)


def article_of(source):
    """What stands in the pages' one article element."""
    body = re.search(r"<article>(.*)</article>", source or "", re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n".join(t for t in texts if t)


def test_query_against_the_article_element(spark, sf_dir):
    rows = queries.QUERIES["op8_html"](spark, sf_dir).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text) == (pages[r.page_id].url, article_of(pages[r.page_id].html))
        assert r.n_chars == len(r.text)


def test_tree_fits_its_table_and_looks_at_words_and_links():
    rows, labels = html_extract.labelled_table()
    assert all(html_extract.decide(TREE, r) == bool(y) for r, y in zip(rows, labels, strict=True))
    used, todo = set(), [TREE]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            used.add(html_extract.FEATURES[node[0]])
            todo += node[2:]
    assert {"words", "link_density", "previous_link_density", "next_link_density"} & used >= {"words", "link_density"}


@pytest.mark.parametrize("wrapped", ["<article>{}</article>", "<main>{}</main>", "<div id='main-content'>{}</div>"])
def test_what_is_not_main(wrapped):
    body = wrapped.format("<header><h2>Head line</h2></header><p>Hello <a href=x>you</a> &amp; all&nbsp;others.</p><p>Two.</p>")
    noise = (
        "<header class='site-header'><h1>My site</h1><nav><a href=/>Home</a></nav></header>"
        "<div class='cookie-notice'>We use cookies to make this site better for everybody who comes here.</div>"
        "<script>var t='</p>'; if (a < b) { x = '<p>no</p>' }</script><style>p > a {color: red}</style>"
    )
    after = (
        "<aside class='widget'>Read also this and that</aside><form><label>Your mail address please</label><input></form>"
        "<section class='comments'><article><p>A reader's comment that is quite long and goes on for a while.</p></article>"
        "</section><div class=advert>Buy now</div><!-- <p>gone</p> --><footer>&copy; 2020</footer>"
    )
    assert main(f"<html><body>{noise}{body}{after}</body>") == "Head line\nHello you & all others.\nTwo."


def test_white_space_entities_and_lists():
    source = "<article><p>a\n\t b<br>c</p><ul><li>one<li>two &lt;b&gt; &#233;&eacute</ul><pre>x  y</pre></article>"
    assert main(source) == "a b c\none\ntwo <b> éé\nx y"


def test_page_without_marked_main_part():
    menu = "<div><a href=/>Home</a></div><div><a href=/a>About us</a></div>"
    text = "<div><p>" + "many words in a row " * 8 + "</p><p>Short.</p><p>" + "and still more of them " * 6 + "</p></div>"
    got = main(f"<body>{menu}{text}{menu}</body>")
    assert got.split("\n")[1] == "Short." and "Home" not in got and "About" not in got


@pytest.mark.parametrize(
    "source",
    ["", "<", "<p", "<a <a <a", "</p></p>", "<!-- open", "<script>never closed", "<p title='x>y", "&#xD800;", "<div>" * 5000, "<a '" * 5000],
)
def test_broken_markup_never_fails(source):
    assert isinstance(main(source), str)


@pytest.mark.parametrize(
    "noise",
    ["<ol class='commentlist'><li>{}</li></ol>", "<div id='siteFooter'>{}</div>", "<ul class='topnav'><li>{}</li></ul>",
     "<div class='c-newsletter__box'><p>{}</p></div>", "<div hidden>{}</div>", "<div style='display: none'>{}</div>",
     "<div role='complementary'>{}</div>", "<div>{}</div>"],
)
def test_names_of_containers(noise):
    text = "<header class='entry-header'><h1 class='entry-title'>Head</h1></header><div class='entry-content'><p>Body.</p></div>"
    apart = noise.format("Some noise that goes on for a number of words")
    page = f"<body><div id='content'>{apart}<article class='post tag-comments'>{text}</article>{apart}</div></body>"
    assert main(page) == "Head\nBody."


def test_quotes_hold_tags():
    assert [b.text for b in text_blocks("<p title='a > b' class=\"c > d\">e</p>")] == ["e"]


def test_awkward_rows(spark):
    rows = [(1, None, "u"), (2, "", "u"), (None, "<article>" + "word " * 50_000 + "</article>", None), (3, "<nav>x</nav>", "u")]
    rows += rows[-1:]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string").withColumn("text", F.lit("clash"))
    got = html_extract.extract(pages).select("page_id", "url", F.char_length("text")).collect()
    want = [(1, "u", 0), (2, "u", 0), (None, None, 249_999), (3, "u", 0), (3, "u", 0)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert html_extract.extract(pages.limit(0)).count() == 0


BODY = "<p>" + "The body of this page goes on for some words. " * 4 + "</p><p>Its end.</p>"
TEXT = " ".join(["The body of this page goes on for some words."] * 4) + "\nIts end."


@pytest.mark.parametrize(
    "name",
    ["site has-sidebar", "no-sidebar", "with-comments", "content-sidebar-wrap", "sidebar", "commentary", "cookies-recipe", "page social",
     "newsletters-archive", "hasSidebar", "layout layout--sidebar-left"],
)
def test_article_within_a_named_container(name):
    for element in ("article", "main"):
        page = f"<body><nav><a href=/>Home</a></nav><div class='{name}'><{element}>{BODY}</{element}></div></body>"
        assert main(page) == TEXT


@pytest.mark.parametrize(
    "name",
    ["social", "legal", "search", "links", "dialog", "byline", "commentary", "cookies-recipe", "entry-meta", "has-ads", "post-header"],
)
def test_named_parts_of_an_article(name):
    part = f"<div class='{name}'><p>A part of the text.</p></div>"
    assert main(f"<body><article>{part}{BODY}</article></body>") == "A part of the text.\n" + TEXT


@pytest.mark.parametrize(
    "noise",
    ["<div class='comments-area'><article><p>{}</p></article></div>", "<aside><article><p>{}</p></article></aside>", "<div class='ad-slot'>{}</div>",
     "<div class='sidebar-inner'>{}</div>", "<div class='cookie-banner'>{}</div>", "<div id='disqus_thread'>{}</div>", "<div class='share-buttons'>{}</div>",
     "<div class='post-comments-area'><article>{}</article></div>", "<div class='commentsbox'>{}</div>", "<div hidden>{}</div>"],
)
def test_containers_that_stay_apart(noise):
    apart = noise.format("Some noise that goes on for a number of words")
    assert main(f"<body>{apart}<article>{BODY}{'' if 'article' in noise else apart}</article>{apart}</body>") == TEXT


@pytest.mark.parametrize("end", ["", "</head>", "<link rel=x><noscript><style>p {}</style></noscript>", "<noscript><img src=x>"])
@pytest.mark.parametrize("body", ["<body>", "<body class=x><main>", "<div>", "<article>", ""])
def test_page_without_end_of_head(end, body):
    if end.endswith("<img src=x>") and not body.startswith("<body"):
        end += "</noscript>"
    page = f"<html><head><meta charset=utf-8><title>No text</title>{end}{body}{BODY}"
    assert main(page) == TEXT
    assert main(f"<head><title>No text</title>{end}{body}Plain words first.{BODY}").startswith("Plain words first.")


@pytest.mark.parametrize("quote", ["", "'", '"'])
def test_links_with_and_without_quotes(quote):
    """A slash that ends an unquoted value does not close the link."""
    menu = "".join(f"<li><a href={quote}/{name}/{quote}>{name} page</a></li>" for name in ("news", "sport", "more"))
    blocks = text_blocks(f"<ul>{menu}</ul><p>Text with an <a name=here/>anchor and <div class=x/>a box</div>.</p>")
    assert [(b.words, b.link_words) for b in blocks][:3] == [(2, 2)] * 3
    assert all(b.link_words == 0 for b in blocks[3:]) and sum(b.words for b in blocks[3:]) >= 7
