import pytest

from roadlark.llm import pages
from roadlark.llm.pages import main_text

BODY = "".join(f"<p>Paragraph {i} tells a story, with commas, and ends here. It has <b>two</b> sentences.</p>" for i in range(6))
WANT = "\n".join(f"Paragraph {i} tells a story, with commas, and ends here. It has two sentences." for i in range(6))


@pytest.mark.parametrize(
    "around",
    [
        "<article><h1>Title</h1>{}</article>",
        "<div id=content><h1>Title</h1>{}</div>",
        "<main><section><h1>Title</h1>{}</section></main>",
        "<div class='page with-sidebar'><div class=post-body><h1>Title</h1>{}</div></div>",
    ],
)
def test_article_without_what_surrounds_it(around):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) '</p>';</script></head><body>"
        "<header><div>My site, the best.</div></header><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies, as all do. Accept them, please.</div>"
        "<div class=ad>Buy now, it is cheap, and good.</div><aside><p>Popular, and read by many people today.</p></aside>"
        + around.format(BODY)
        + "<form><p>Subscribe to our letter, it is free.</p><input name=a><button>Go</button></form>"
        "<section id=comments><div class=comment><p>I like this text, really, it is good.</p></div></section>"
        "<div hidden><p>Not shown, at all, to anybody here.</p></div><!-- <p>gone</p> --><footer>&copy; me</footer></body></html>"
    )
    assert main_text(page) == "Title\n" + WANT


def test_references_blanks_and_open_tags():
    page = "<article><p>A &amp; B&nbsp;&lt;i&gt; caf&eacute;,\n  and   more\ttext. <p>Second <i>one, <br>goes on. <p title='a > b'>Third, too."
    assert main_text(page) == "A & B <i> café, and more text.\nSecond one, goes on.\nThird, too."


def test_lists_tables_and_quotes_of_an_article_stay():
    page = f"<article>{BODY}<ul><li>first item<li>second item</ul><table><tr><td>cell one<td>cell two</table><blockquote>Quoted, words.</blockquote></article>"
    assert main_text(page) == WANT + "\nfirst item\nsecond item\ncell one\ncell two\nQuoted, words."


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<script>x</script>", "<", "<p", "<!--", "</", "<a href='"])
def test_pages_without_text(page):
    assert main_text(page) in ("", "<")


def test_pages_cut_off_and_plain_text():
    assert main_text("Only words, no tags.") == "Only words, no tags."
    assert main_text("<article><p>Whole words, here.<p>cut &am") == "Whole words, here.\ncut &am"
    assert main_text("<article><p>Whole words, here.<p class='x") == "Whole words, here."
    assert main_text("a < b and c > d, so it is.") == "a < b and c > d, so it is."


def test_long_page_and_table(spark):
    long = "<article>" + "<p>Some words, and more of them here.</p>" * 20000
    rows = [(1, "u", long), (2, None, None), (None, "v", "<p>Text, here."), (2, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = sorted(pages.extract(df).collect(), key=lambda r: r.n_chars)
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(2, None, 0), (2, None, 0), (None, "v", 11), (1, "u", len("Some words, and more of them here.") * 20000 + 19999)]
    assert pages.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("page", [
    "<body><a name=top><h1>Title</h1>{}</body>",
    "<body><a id=top><div><h1>Title</h1>{}</div></body>",
    "<body><a href=/x><article><h1>Title</h1>{}</article></a></body>",
    "<body><div><a href=/x><h1>Title</h1>{}</a></div></body>",
    "<body><h1>Title</h1><a name=start>{}</body>",
    "<body><nav><a href=/>Home<a href=/x>News</nav><article><a href=/y><h1>Title</h1></a>{}</article></body>",
])
def test_anchors_and_block_links_hide_no_article(page):
    assert main_text(page.format(BODY)) == "Title\n" + WANT


def test_linked_lines_of_an_article_stay_and_menus_go():
    source = "<p><a href=/s>The source of this story</a></p><ul><li><a href=/1>First work</a><li><a href=/2>Second work</a></ul>"
    for around in ("<article>{}</article>", "<div><div>{}</div></div>"):
        assert main_text("<body>" + around.format(BODY + source) + "</body>") == WANT + "\nThe source of this story\nFirst work\nSecond work"
        menu = "<ul>" + "".join(f"<li><a href=/{i}>Place {i}</a>" for i in range(5)) + "</ul><div>" + " | ".join(f"<a href=/{i}>Part {i}</a>" for i in range(4)) + "</div>"
        assert main_text("<body>" + around.format(menu + BODY) + "</body>") == WANT
    assert main_text(f"<body><div><a href=/>Home</a></div>{BODY}</body>") == WANT


def test_broken_nesting_takes_linear_time():
    import time

    for page in ("<div>x " * 8000, "<a href=x><span>y " * 8000, "<b>z<p>" * 8000, "<ul><li>" * 4000 + "</section>w" * 4000):
        begin = time.perf_counter()
        pages.main_text(page)
        assert time.perf_counter() - begin < 3


def test_sections_with_names_of_their_own_stay_in_an_article():
    long = "Some words of the article, and more of them. " * 8
    page = (
        f"<article><h1>Title</h1><p>{long}</p>"
        "<section class='related-work'><h2>Related work</h2><p>Others did so before, too.</p></section>"
        "<div id='social-history'><p>A history, in short.</p></div>"
        "<div class='related-posts box-2'><p>See this post, and that one.</p></div>"
        "<div id='comment-list'><p>First comment, by a reader.</p></div></article>"
    )
    text = pages.main_text(page)
    assert "Others did so" in text and "Related work" in text and "A history" in text
    assert "See this post" not in text and "First comment" not in text
