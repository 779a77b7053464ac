"""Main text of pages: the tables' own articles, and pages with everything that is not one."""

import html as entities
import re
import time

import pytest

from ordertrail.llm import html_tree
from ordertrail.llm.html_tree import main_text
from ordertrail.llm.queries import op7_html_extraction

LONG = "a paragraph that is long enough to count, with commas, and more words"


def article(page):
    """The blocks of the generator's article, by its own marks."""
    inside = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = [re.sub(r"<[^>]*>", " ", part) for part in re.split(r"</?(?:p|h1)>", inside)]
    return [" ".join(entities.unescape(b).split()) for b in blocks if b.strip()]


def test_query(spark, folder):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op7_html_extraction(spark, folder).collect()
    assert {r["page_id"] for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        assert r["text"].split("\n") == article(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p", ""), ("just words", "just words"), ("<p>a &amp b &lt; c&nbsp;&#233;<p>d", "a & b < c é\nd"),
    (f"<header><p>{LONG}</p></header><main><h1>T</h1><p>{LONG}</p><p>short</p></main><footer>{LONG}</footer>",
     f"T\n{LONG}\nshort"),
    (f"<div class='sidebar'><p>{LONG} {LONG}</p></div><div><p>{LONG}</p><ul><li>one<li>two</ul></div>", f"{LONG}\none\ntwo"),
    (f"<div id=c><p>{LONG}</p><form><p>{LONG}</p></form><div class='comments'><p>{LONG}, {LONG}</p></div></div>", LONG),
    (f"<body class='has-sidebar'><article class='comment-page'><p>{LONG}</p></article></body>", LONG),
    (f"<div><a href=x>{LONG}</a><a>{LONG}</a></div><div><p>{LONG}</p></div>", LONG),
    (f"<article><p>{LONG}<script>var a='</p>, , ,';</script><style>p{{}}</style><!-- <p>no --></p></article>", LONG),
    (f"<p>{LONG}</p><p hidden>{LONG}</p><div style='display: none'>{LONG}</div><div role=dialog>{LONG}</div>", LONG),
    ("<article>tiny</article><nav>menu</nav>", "tiny"),
    (f"<div><p>{LONG}<br>second line</p></div><script>unclosed", f"{LONG} second line"),
])
def test_pages(page, text):
    assert main_text(page) == text


THREE = "x" * 170 + ", and, so"
BODY = f"<p>{THREE}, {THREE}</p>" * 10
SAID = "\n".join([f"{THREE}, {THREE}"] * 10)
MENU = "<ul>" + "<li><a href=x>some other page of this site</a></li>" * 4 + "</ul>"


@pytest.mark.parametrize("page, text", [
    (f"<div><h1>T</h1><p>lead</p><div class=body>{BODY}</div><p>closing</p></div>", f"T\nlead\n{SAID}\nclosing"),
    (f"<div><h1>T</h1><div class=wrap><div class=body>{BODY}</div></div><p>closing</p></div>", f"T\n{SAID}\nclosing"),
    (f"<div><div><h1>T</h1>by me</div><div>{BODY}</div><ul><li>one</li></ul><pre>x = 1</pre></div>",
     f"T\nby me\n{SAID}\none\nx = 1"),
    (f"<div><section>{BODY}</section><section><p>{THREE}</p></section><section><h2>S</h2><p>short</p></section></div>",
     f"{SAID}\n{THREE}\nS\nshort"),
    (f"<body><div>{BODY}</div><section><p>{THREE}</p></section><p><a href=x>More</a></p></body>", f"{SAID}\n{THREE}"),
    (f"<main><article><h1>T</h1><div><div>{BODY}</div><div>short</div></div><section><p>{THREE}</p></section><p>end</p>"
     f"</article></main>", f"T\n{SAID}\nshort\n{THREE}\nend"),
    (f"<main><h1>T</h1><p>lead</p><article><div>{BODY}</div></article><div>note</div>{MENU}</main>", f"T\nlead\n{SAID}\nnote"),
    (f"<body><div>Site</div><h1>T</h1><div>{BODY}</div><h2>Other pages</h2>{MENU}</body>", f"T\n{SAID}"),
    (f"<div>lead words<div>{BODY}</div>last words</div>", f"lead words\n{SAID}\nlast words"),
])
def test_nested_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<article><p>{LONG}</p><section id=discussion><h2>Discussion</h2><p>{LONG}</p></section></article>",
     f"{LONG}\nDiscussion\n{LONG}"),
    (f"<article><h2 id=related-work>Related work</h2><p>{LONG}</p><h2 id='social-impact'>Impact</h2></article>",
     f"Related work\n{LONG}\nImpact"),
    (f"<article><p class=notice-period>{LONG}</p></article>", LONG),
    (f"<div><p data-id='nav-1'>{LONG}</p><p title='a hidden gem'>{LONG}</p><p data-x=hidden>{LONG}</p></div>",
     "\n".join([LONG] * 3)),
    (f"<article><p>{LONG}</p><div class=related>{MENU}</div><div class='share'><p>{LONG}<input></p></div>"
     f"<div class=reply><div class=notice><form><p>no</p></form>{LONG}</div></div><div class='sidebar'>{LONG}</div></article>", LONG),
    (f"<article><p>{LONG}</p><div CLASS=sidebar>{LONG}</div><p ARIA-HIDDEN='true'>{LONG}</p><p HIDDEN>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG} <span class=share><a href=x>Post it</a></span><a class=social>Tweet</a><b class=notice>mind</b></p>"
     f"<div class=ad>{LONG}</div></article>", f"{LONG} mind"),
    (f"<div><p>{LONG}</p><div class=discussion><p>{LONG}</p></div></div>", LONG),
])
def test_names_inside_articles(page, text):
    assert main_text(page) == text


WHO = "<span class=author>Ann</span> <time>3 May</time>"


@pytest.mark.parametrize("page", [
    f"<article>{BODY}<ul class=comment-list><li class=comment><p>{THREE}. Yes.</p><li class=comment>{THREE}</ul></article>",
    f"<article>{BODY}<div class=comment><p>{THREE}. I agree.</p></div><div class=comment>{THREE}. No.</div></article>",
    f"<main><article>{BODY}</article><div class=comment-thread><article class=comment><p>{THREE}. Yes.</p></article></div></main>",
    f"<main><article>{BODY}</article><article class=comment><p>{THREE}. Yes.</p></article></main>",
    f"<main>{BODY}<section class=discussion><h2>3 replies</h2><p>{THREE}. Yes.</p><p>{THREE}. No.</p></section></main>",
    f"<main>{BODY}<section class=discussion><div>{WHO}<p>{THREE}. Yes.</p></div></section></main>",
    f"<article>{BODY}<div class=notice>Please accept our terms</div></article>",
    f"<article>{BODY}<p class=site-notice>Please accept our terms</p></article>",
    f"<article>{BODY}<div class=toolbar>Print Save</div></article>",
    f"<article>{BODY}<article><p>{THREE}. One.</p></article><article><p>{THREE}. Two.</p></article></article>",
    f"<article>{BODY}<section><article>{WHO}<p>{THREE}. One.</p></article></section></article>",
])
def test_comments_and_notices_are_no_article_text(page):
    assert main_text(page) == SAID


@pytest.mark.parametrize("page, text", [
    (f"<article>{BODY}<section class=discussion><h2>Discussion</h2><p>{THREE}. We found it.</p></section></article>",
     f"{SAID}\nDiscussion\n{THREE}. We found it."),
    (f"<article>{BODY}<div class='notice-period'><p>It ends in May.</p></div></article>", f"{SAID}\nIt ends in May."),
    (f"<article><pre>x = 1 <span class=comment># one</span></pre>{BODY}</article>", f"x = 1 # one\n{SAID}"),
    (f"<article class=all><article>{BODY}</article></article>", SAID),
    (f"<article><p>{THREE}</p><article>{BODY}</article><p>{THREE}, {THREE}</p></article>",
     f"{THREE}\n{SAID}\n{THREE}, {THREE}"),
    (f"<article><header><div><h1>T</h1></div><p>By me, on Monday</p></header>{BODY}</article>", f"T\n{SAID}"),
    (f"<header><h1>Site</h1></header><article>{BODY}</article>", SAID),
    (f"<article>{BODY}<section id=reply-to-critics><h2>Reply to critics</h2><p>{THREE}. No.</p></section></article>",
     f"{SAID}\nReply to critics\n{THREE}. No."),
])
def test_what_only_sounds_like_them_stays(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("make", [lambda n: "<section>" * n + "<li>x" * (2 * n), lambda n: "<div><p>" * n + "<td>" * n,
                                  lambda n: "<b><dd>" * n, lambda n: "<tr><td>" * n + "</tr>" * n])
def test_deep_pages_take_time_in_proportion(make):
    def seconds(n):
        start = time.process_time()
        main_text(make(n))
        return time.process_time() - start

    assert min(seconds(8000) for _ in range(2)) < 10 * max(0.02, min(seconds(2000) for _ in range(2)))


@pytest.mark.parametrize("page, text", [
    (f"<article><p>{LONG}<svg class=i/> and on</p><p>{LONG}</p></article>", f"{LONG} and on\n{LONG}"),
    (f"<article><p>{LONG}</p><svg class='i' /><p>two</p><svg><title>t</title><path d='M0'/><text>no</text></svg><p>three</p>"
     "</article>", f"{LONG}\ntwo\nthree"),
    (f"<article><object data=x><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p><div><video src=x></div><p>{LONG}</p></article><div><video>no</video></div>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p><div><object data=x></div><p>{LONG}</p></article><div><object>no</object></div>",
     f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG} <video><p>no</p> no</video> end</p><canvas>no</canvas><audio>no</audio></article>", f"{LONG} end"),
    (f"<article><object><object><p>no</p></object>no</object><p>{LONG}</p><template><p>no</p></template><p>end</p>"
     "<noscript><p>no</p></noscript></article>", f"{LONG}\nend"),
    (f"<article><p>{LONG} <math><mi>E</mi><mo>=</mo><mi>m</mi><mspace/><msup><mi>c</mi><mn>2</mn></msup></math> holds</p>"
     "</article>", f"{LONG} E=mc2 holds"),
    (f"<article><p>{LONG} <math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math></p></article>", f"{LONG} x"),
    (f"<p>{LONG}<iframe><p>no</p></iframe></p>", LONG),
])
def test_what_is_not_shown_ends(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<svg>" * 20000 + LONG, "<video>" * 20000 + "</video>", "<object>" * 20000 + "</object>" * 3,
                                  "<p><object>" * 20000 + "</object>", "<math><mi/>" * 20000, "<svg/>" * 20000])
def test_odd_pages_of_unshown_elements_end(page):
    main_text(page)


@pytest.mark.parametrize("page", ["<div>" * 20000 + LONG, "<p>" * 20000, "<a '" * 20000, "<li>" * 20000 + "x", "</p>" * 20000,
                                  "<b>" * 20000 + "</i>" * 20000, "&" * 100000, "<!--" * 20000, "<" * 100000])
def test_odd_pages_end(page):
    main_text(page)


def test_rows(spark):
    rows = [(1, None, "t"), (1, None, "t"), (None, f"<p>{LONG}</p>", "u"), (2, "", "v"), (3, f"<p>{LONG}</p>" * 5000, "w")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = html_tree.extract(df, ["page_id", "text"])
    assert found.columns == ["page_id", "text"]
    rows = found.collect()
    assert len(rows) == 5 and sorted(len(r["text"]) for r in rows)[:4] == [0, 0, 0, len(LONG)]
    assert html_tree.extract(df.limit(0), ["page_id"]).count() == 0
