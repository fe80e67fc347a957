import pytest

from hydromart.llm import html as M

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad --><div class="ad">Buy &amp; save a lot today.</div>
<div class="cookie-notice"><p>We use cookies on this page.</p></div><article><h1>Title  of&nbsp;it</h1><p>First &amp;amp; <b>bold</b> text
runs on<br>after a break<p>Short.<ul><li>one<li>two</ul><form>Name <input><button>Go</button></form><script>x()</script>
<div id="comments"><p>Great post, really enjoyed every word!</p></div><p>Last paragraph &lt;x&gt; &#233;.</article>
<aside><p>Related things that go on for a long while.</p></aside><section class="comments">No!</section><footer>&copy; me</footer>"""


def test_article():
    assert M.extract(ARTICLE).split("\n") == ["Title of it", "First &amp; bold text runs on", "after a break", "Short.", "one", "two",
                                              "Last paragraph <x> é."]


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain text", "plain text"), ("<p>a</p>", "a"), ("<article></article>", ""), ("<nav>x</nav>", ""),
    ("<div><p>one<p>two <i>three</i></div>", "one\ntwo three"), ("</p></div>stray", "stray"), ("<unknown>u</unknown>", "u"),
    ("<p>unclosed <b>bold", "unclosed bold"), ("<article><p>in</p></article><p>out of it, and rather long</p>", "in"),
    ("<br/><img src=x>t", "t"), ("<p hidden>h</p><p>v</p>", "v"), ("&amp;", "&"), ("<p>" + "w " * 50000 + "</p>", ("w " * 50000).strip())])
def test_edges(page, text):
    assert M.extract(page) == text


def test_short_paragraphs_between_long_ones_stay():
    blocks = ["Long paragraph " * 20, "A.", "B.", "Another long paragraph " * 20, "C."]
    page = "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    assert M.extract(page) == "\n".join(b.strip() for b in blocks)


PROSE = "A paragraph of plain prose that goes on for a good while and says what the page is about. " * 3
MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Travel", "Weather", "Help", "About"))


def test_clusters_choose_where_nothing_is_marked():
    page = f"<div><ul>{MENU}</ul></div><div><h2>Head</h2><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p></div><div><p>Links</p>{MENU}</div>"
    assert M.extract(page).split("\n") == ["Head", PROSE.strip(), "Short.", PROSE.strip()]
    assert "Home" in M.extract(page, share=0.0)  # no threshold, so the last menu's heading is chosen as well
    inside = f"<div><p>{PROSE}</p><ul>{MENU}</ul><p>{PROSE}</p></div>"
    assert "Travel" in M.extract(inside)  # a list of links in the middle of the content
    assert M.extract(f"<ul>{MENU}</ul>").split("\n")[0] == "Home"  # nothing else to choose
    assert M.extract(f"<div><a href=/x><p>{PROSE}</p></a></div>") == PROSE.strip()


def test_marked_articles_and_clusters_outside():
    page = f"<p>By us</p><div><p>{PROSE}</p><p>Mid.</p><p>{PROSE}</p></div><article><p>{PROSE}</p></article><article><p>ab</p></article><div>x</div>"
    assert M.extract(page).split("\n") == [PROSE.strip(), "Mid.", PROSE.strip(), PROSE.strip(), "ab"]
    short = "<article>" + "<p>a</p>" * 9 + "</article>" + f"<article><p>{PROSE}</p></article>"
    assert M.extract(short).split("\n") == ["a"] * 9 + [PROSE.strip()]


def test_query(spark, tmp_path):
    rows = [(1, "u1", ARTICLE, 5), (1, "u1", ARTICLE, 5), (2, None, None, 6), (None, "u3", "", 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = M.op5_html_extract(spark, str(tmp_path)).collect()
    assert sorted(((r.page_id, r.url, r.n_chars) for r in got), key=repr) == sorted(
        [(1, "u1", len(M.extract(ARTICLE)))] * 2 + [(2, None, 0), (None, "u3", 0)], key=repr)
    assert M.extract_pages(df.limit(0)).count() == 0


def test_pages_table_against_a_plain_reading(spark):
    """On the given pages, the article's blocks cut by a plain pattern are the expected text."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for p in pages:
        inside = re.search(r"(?s)<article>(.*?)</article>", p.html)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br)[^>]*>", inside)]
        assert M.extract(p.html) == "\n".join(b for b in blocks if b)
