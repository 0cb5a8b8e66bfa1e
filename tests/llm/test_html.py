from panelcast.llm.html_text import content_paths, blocks_of, extract_main_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li><li><a href="/y">About, us.</a></li></ul></nav><!-- <p>hidden, text. -->
<div class="ad">Buy now, it is cheap.</div><article><h1>The title</h1><p><b>First &amp; longest, of all.<br><p>It ends
   here &lt;soon&gt;, really.</p><p>Short</p><form><p>Sign up, please.</p></form><div id="comments"><p>I like it, a lot.</p></div>
<script>more()</script></article><footer>&copy; 2020, all rights.</footer></body></html>"""

PLAIN = """<body><div class="header"><h1>Site</h1></div><div id="menu"><a href=x>Home</a> <a href=y>About us</a></div>
<div class=content><h2>Title of the story</h2><p>First paragraph, with a long text, that goes on and on; it has marks.</p>
<p>Second one, as long as the first was, and again with marks. Fine.</p><p>Short.</p></div>
<div><div><a href=1>one</a></div><div><a href=2>two</a></div></div><div class="sidebar"><p>Related, stories, to read. Yes.</p></div></body>"""


def test_article_without_what_surrounds_it():
    assert main_text(PAGE) == "The title\n\nFirst & longest, of all.\n\nIt ends here <soon>, really.\n\nShort"


def test_content_paths_are_found_without_an_article_element():
    assert main_text(PLAIN).split("\n\n")[0] == "Title of the story"
    assert main_text(PLAIN).endswith("Fine.\n\nShort.") and "Related" not in main_text(PLAIN) and "one" not in main_text(PLAIN).split()[-3:]
    blocks = blocks_of(PLAIN)
    assert {p[-1] for p in content_paths(blocks)} == {"p"}


LONG = "A paragraph of the story, with words that go on for a while; it ends here, at last."


def test_listed_words_in_values_and_slugs_drop_nothing():
    for start in ('<p title="the hidden cost">', '<p data-x="id=ad">', "<p data-class='ad'>", '<p class="lead" aria-label="role=search">'):
        assert main_text(f"<article><p>{LONG}</p>{start}{LONG} Again.</p></article>") == f"{LONG}\n\n{LONG} Again."
    link = '<a href="/the-hidden-valley">the valley</a>, <a href="/view?id=ad-7">the view</a>, <a id="search" href=x>found</a>'
    assert "the valley, the view, found" in main_text(f"<article><p>{LONG} {link}</p></article>")
    for start, end in (('<section id="related-work">', "</section>"), ('<h2 id="search-trees">Trees</h2>', ""), ('<h2 id="notice">Trees</h2>', "")):
        got = main_text(f"<article><p>{LONG}</p>{start}<p>{LONG} More.</p>{end}<p>{LONG} End.</p><p>{LONG}</p></article>")
        assert got.count("A paragraph") == 4 and ("Trees" in start) == ("Trees" in got)


def test_a_named_layout_around_the_article_keeps_it():
    story = f"<h1>The story</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
    for name in ('class="layout with-sidebar"', 'id="post-with-comments"', 'class="ad"'):
        for inner in (story, f"<article>{story}</article>"):
            got = main_text(f'<body><div {name}>{inner}<div class="sidebar"><p>Short, and apart.</p></div></div></body>')
            assert got.startswith("The story") and got.count(LONG) == 3 and "apart" not in got


STORY = f"<h1>The story</h1><p>{LONG}</p><p>{LONG}</p>"


def test_pages_with_missing_ends_and_frames_keep_their_story():
    for page in (
        f"<html><head><title>x</title><body>{STORY}</body></html>",
        f"<head><title>x</title><meta charset=utf-8>{STORY}",
        f"<body><form method=post action='/p'><input type=hidden value=1><div><h1>The story</h1></div><p>{LONG}</p><p>{LONG}</p></form></body>",
        f"<body><form><header>Zzz, top.</header><div>{STORY}</div><footer>Zzz, end.</footer></form></body>",
        f"<article><h1>The story</h1><p title=it's>{LONG}</p><p data-a=x\"y>{LONG}</p></article>",
        f"<body><nav><a href=/>Home</a><main>{STORY}</main></body>",
        f"<body><nav><ul><li><a href=/>Home</a></li></ul><div>{STORY}</div></body>",
        f"<body><header><p>Site</p><div><article>{STORY}</article></div>",
        f"<body><!-- a --!><article>{STORY}</article><!--> <p>x",
    ):
        got = main_text(page)
        assert got.count(LONG) == 2 and "The story" in got, page
        assert "Home" not in got and "Zzz" not in got


def test_forms_go_at_any_place():
    for form in ("<form><label>Name</label><input><p>Sign up, please, and get news.</p></form>", "<form><p>Search, here.</p></form>"):
        assert main_text(f"<body><article>{STORY}{form}</article>{form}</body>") == f"The story\n\n{LONG}\n\n{LONG}"


def test_reader_comments_go_at_any_size():
    comment = f"<div class=comment><b>Ann</b><p>{LONG} I say so, too.</p></div>"
    for n in (1, 6, 40):
        for box in ("<div id=comments>", '<section class="comments">', '<div class="reader-comments replies">'):
            for page in (f"<main>{STORY}{box}{comment * n}</div></section></main>", f"<main>{STORY}</main>{box}{comment * n}"):
                got = main_text(page)
                assert got == f"The story\n\n{LONG}\n\n{LONG}", (n, box)


def test_listed_names_inside_a_sentence_keep_it_whole():
    assert "see a share of it" in main_text(f"<article><p>{LONG}</p><p>{LONG} see <span class='share'>a share</span> of it</p></article>")
    assert "Buy" not in main_text(f"<article><p>{LONG}</p><p><span class='ad'>Buy now, cheap.</span></p><p>{LONG}</p></article>")


def test_all_white_space_is_folded():
    assert main_text("<article><p>one\u2003\u3000two\u00a0\n three</p></article>") == "one two three"


def test_what_is_hidden_is_left_out():
    for start in ("<p hidden>", "<p HIDDEN=''>", '<p aria-hidden="true">', "<p style='display: none'>", '<div role="search">'):
        assert "unseen" not in main_text(f"<article><p>{LONG}</p>{start}unseen</article>")


def test_ratios_decide_inside_a_marked_article_too():
    story = f"<h1>The story</h1><p>{LONG}</p><p>{LONG}</p>"
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")):
        got = main_text(f"<body>{open_}{story}<div>Buy now</div><p>{LONG}</p><div>Reader, 3 May</div>{close}</body>")
        assert got.count(LONG) == 3 and "Buy" not in got and "Reader" not in got
    assert main_text(f"<article>{story}<ul><li>a point</li></ul><blockquote>Said so</blockquote><p>{LONG}</p></article>").count("\n\n") == 5


def test_teasers_in_articles_do_not_hide_an_unmarked_story():
    teasers = "".join(f'<article><h3>Other {i}</h3><span>Some words on it, <a href="/{i}">more</a></span></article>' for i in range(6))
    got = main_text(f"<body><div><div><h1>The story</h1>{f'<p>{LONG}</p>' * 4}</div></div><div>{teasers}</div></body>")
    assert got.startswith("The story") and got.count(LONG) == 4


def test_truncated_and_odd_pages():
    assert main_text("") == "" and main_text("<p") == "" and main_text("<div>a < b and c &am") == "a < b and c &am"
    assert main_text("no tags, only text.") == "no tags, only text."
    assert main_text("<article><p>one &nbsp; two<p>three") == "one two\n\nthree"
    assert main_text("<script>x()</script>") == ""
    assert len(main_text("<article>" + "<p>word word, word.</p>" * 20_000)) == 20_000 * 18 - 2


def test_every_page_has_a_row(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((repr(r.page_id), r.text == main_text(PAGE), r.n_chars == len(r.text)) for r in got) == [
        ("1", True, True),
        ("1", True, True),
        ("2", False, True),
        ("None", False, True),
    ]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
