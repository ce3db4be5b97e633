import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwarden.llm import html

LONG = "This is a sentence of the article that is long enough to count as running text. " * 2


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = f"<article><h1>Head &amp; line</h1><p>{LONG}</p><p>Short.</p><p>{LONG}<br>after <b>bold</b> &eacute;&#233;&#xE9;</p></article>"
WANT = f"Head & line\n{LONG.strip()}\nShort.\n{LONG.strip()}\nafter bold ééé"


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=x>Home</a></li></ul></nav>{}<footer>&copy; all</footer>",
        "<header>Site</header><aside>side text</aside>{}<script>var a='<p>no</p>';</script><style>p{{x}}</style>",
        "<div class='ad'>Buy things now, they are very cheap and good for everybody who reads this page.</div>{}<form><input><p>Name</p></form>",
        "<div id='cookie-notice'>We use cookies</div>{}<div class='comments'><p>First! " + LONG + "</p></div>",
        "<!-- a <p>comment</p> -->{}<section role='complementary'>" + LONG + "</section><noscript>on</noscript>",
        "<div><div class='site_menu'>" + LONG + "</div>{}</div>",
    ],
)
def test_article_without_its_surroundings(around):
    assert html.main_text(page(around.format(ARTICLE))) == WANT


def test_comments_and_adverts_inside_the_article():
    inner = ARTICLE.replace("<p>Short.</p>", "<p>Short.</p><div class='ads'>Buy</div><section id='comments'><p>Hello there</p></section>")
    assert html.main_text(page(inner)) == WANT


@pytest.mark.parametrize(
    "box",
    [
        "<aside><p>Side one</p><p>Side two</p><p>Side three</p><p>Side four</p></aside>",
        "<form><p>Name</p><p>Mail</p><p>Town</p></form>",
        "<div class='ad'><p>Buy</p><p>these</p><p>things</p></div>",
        "<div class='newsletter'><p>News</p><p>by mail</p><p>each week</p><p>for you</p></div>",
    ],
)
def test_long_boxes_near_both_ends_of_an_article(box):
    lead, close = LONG[:79], "A short end."
    source = f"<article><h1>Head</h1><p>{lead}</p>{box}<p>{LONG * 20}</p>{box}<p>{close}</p></article>"
    assert html.main_text(page(source)) == f"Head\n{lead}\n{(LONG * 20).strip()}\n{close}"


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='layout has-sidebar'>{}</div>", "<div class='with-sidebar'>{}</div>", "<div id='page-header-content'>{}</div>",
        "<div class='elementor-widget elementor-widget-post'><div class='widget-inner'>{}</div></div>", "<div class='post comments-open'>{}</div>",
        "<div class='page social-layout'>{}<div class='sidebar'><p>About</p><p>the author</p></div></div>",
        "<div class='sidebar-left'><div class='sidebar'><article>Teaser</article></div><div>{}</div></div>",
        "<div class='ad-free'><div id='main-menu'><p>Men</p></div>{}<div id='comments'><article class='comment'>Nice.</article></div></div>",
    ],
)
def test_wrappers_named_like_boilerplate(wrapper):
    assert html.main_text(page(wrapper.format(ARTICLE))) == WANT
    if "Teaser" not in wrapper and "comments'" not in wrapper:
        plain = ARTICLE.replace("<article>", "<div>").replace("</article>", "</div>")
        assert html.main_text(page(wrapper.format(plain))) == WANT


def test_class_words_inside_the_article():
    head = ARTICLE.replace("<h1>", "<div class='entry-header'><h1>").replace("</h1>", "</h1></div>")
    assert html.main_text(page(head)) == WANT
    parts = "".join(f"<div class='elementor-widget'>{p}</div>" for p in ("<h1>Head</h1>", f"<p>{LONG}</p>", f"<p>{LONG}</p>"))
    comments = f"<div id='comments' class='widget'><p>{LONG * 9}</p></div>"
    assert html.main_text(page(f"<article>{parts}{comments}</article>")) == f"Head\n{LONG.strip()}\n{LONG.strip()}"
    inner = f"<main><div class='widget'><article>{LONG}</article></div><div class='widget'><article>{LONG}</article></div></main>"
    assert html.main_text(page(inner)) == f"{LONG.strip()}\n{LONG.strip()}"


def test_long_comments_stay_boilerplate():
    comments = "".join(f"<li><article class='comment-body'>{LONG * 5}</article></li>" for _ in range(3))
    assert html.main_text(page(f"{ARTICLE}<div class='comments'><ol>{comments}</ol></div>")) == WANT
    assert html.main_text(page(f"<main>{ARTICLE}<div class='comments'><ol>{comments}</ol></div></main>")) == WANT


def test_pages_without_an_article_element_use_surge_and_dive():
    menu = "".join(f"<li><a href='{i}'>Link number {i}</a></li>" for i in range(30))
    body = f"<div><ul>{menu}</ul></div><div><p>{LONG}</p><p>Mid.</p><p>{LONG}</p></div><table><tr><td><a href=y>more</a></td></tr></table>"
    assert html.main_text(page(body)) == f"{LONG.strip()}\nMid.\n{LONG.strip()}"


@pytest.mark.parametrize(
    "source,want",
    [
        (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"), ("<article><p><b>x<br><p>y</article>", "x\ny"),
        ("<article><p>cut in a tag <a href='x", "cut in a tag"), ("<article>a &lt; b &amp;amp; c &nope; 1 < 2</article>", "a < b &amp; c &nope; 1 < 2"),
        ("<article>one \n\t two&nbsp; three</article>", "one two three"), ("<article><pre>a\nb</pre></article>", "a b"),
        ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "x\ny\n1\n2"),
        ("<script>only code", ""), ("<!-- never closed <p>x</p>", ""), ("<nav>menu</nav>", ""),
        ("<ARTICLE><P CLASS=lead>Upper</P></ARTICLE>", "Upper"), ("<article><p hidden>no</p><p>yes</p></article>", "yes"),
            ("<article><p>a <span class='ad'>buy</span> b <button>go</button>c</p></article>", "a b c"),
            ('<article><p>a <b title="x>y</b> z</p></article>', "a y z"),
    ],
)
def test_small_pages(source, want):
    assert html.main_text(source) == want


def test_long_pages_are_whole():
    body = "<article>" + "".join(f"<p>Paragraph {i} {LONG}</p>" for i in range(3000)) + "</article>"
    text = html.main_text(page(body))
    assert text.count("\n") == 2999 and text.endswith(LONG.strip())
    assert html.main_text("<div>" * 5000 + LONG + "</div>" * 5000) == LONG.strip()


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="<>/abp &;!-\"'= \n", max_size=80))
def test_any_text_is_taken(source):
    assert isinstance(html.main_text(source), str)


def test_stretches():
    assert html.main_lines([0, 0, 100, 5, 100, 0, 0, 0, 0, 90, 0]) == [False] * 2 + [True] * 3 + [False] * 4 + [True, False]
    assert html.main_lines([]) == []


def test_rows(spark):
    rows = [(1, "u", page(ARTICLE), "x"), (1, "u", page(ARTICLE), "x"), (None, None, None, None), (2, "v", "", "y")]
    out = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(out.collect(), key=lambda r: r.page_id or 0)
    assert [(r.text, r.n_chars) for r in got] == [("", 0), (WANT, len(WANT)), (WANT, len(WANT)), ("", 0)]
    assert html.extract(out.limit(0).selectExpr("page_id", "url", "text AS html")).count() == 0


def test_comments_in_articles_are_not_the_article():
    post, reply = "word " * 60, "other " * 200
    page = f"<div class=post><p>{post}</p></div><section id=comments><article><p>{reply}</p></article></section>"
    assert html.main_text(page) == post.strip()
    only = f"<div id=comments><article><p>{reply}</p></article></div>"
    assert html.main_text(only) == reply.strip()


def test_the_headline_before_the_article_stays():
    body = "word " * 60
    page = f"<header><h1>Site</h1></header><div><h1>The <i>head</i></h1><p>menu</p><article><p>{body}</p></article></div>"
    assert html.main_text(page) == "The head\n" + body.strip()
    page = f"<h1>Other</h1><h1>Near</h1><main><h1>Head</h1><p>{body}</p></main><h1>After</h1>"
    assert html.main_text(page) == "Near\nHead\n" + body.strip()
