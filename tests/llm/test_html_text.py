import html
import random
import re
import time
from collections import Counter

import pytest

from quillon.llm import html_text

SCHEMA = "page_id bigint, url string, html string, text string"
TABLE = "/root/testdata/sf0.01/pages.parquet"


@pytest.fixture(scope="module")
def extractor(spark):
    return html_text.Extractor(html_text.learn_weights(spark.read.parquet(TABLE)))


def _marked(source):
    """The text of the marked article, by plain replacement."""
    inner = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())


def test_given_pages_give_their_article(spark):
    pages = spark.read.parquet(TABLE)
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    for page in pages.collect():
        row = got[page.page_id]
        assert row.text == _marked(page.html) and row.n_chars == len(row.text) and row.url == page.url


def test_the_scan_finds_the_best_contiguous_region(extractor):
    page = (
        "<body><header><h1>Site</h1></header><div class='cookie-notice'>We use them</div>"
        "<div class=content><h2>Title</h2><p>First &lt;b&gt; with <a href=q>lin</a>ks\n and  more."
        "<div class=ads>buy now</div><p>Second<br>goes &eacute; on.<script>x('</p>')</script></div>"
        "<form>Name <input></form><div id=comments><p>Nice post!</p></div><aside>rel</aside><footer>(c)</footer>"
    )
    assert extractor.extract(page) == "Title First <b> with links and more. Second goes é on."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("<nav>only menus</nav>", ""),
        ("plain words", "plain words"),
        ("<p>cut off <a href='", "cut off"),
        ("<p>1 < 2 &amp; 3</p>", "1 < 2 & 3"),
        ("<article><p>one<p>two</article>", "one two"),
        ("<p>" + "word " * 50_000, ("word " * 50_000).strip()),
    ],
)
def test_cases(extractor, source, text):
    assert extractor.extract(source) == text


BODY = "<p>" + "word " * 40 + "<p>" + "more " * 40
TEXT = " ".join(["word"] * 40 + ["more"] * 40)
ASIDES = "<div class='sidebar'>" + "link " * 20 + "</div><div id=comments><article class=comment>Nice post</article></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body class='has-sidebar'><article>{BODY}</article>{ASIDES}</body>",
        f"<html class='no-cookie'><body class='ad-free'><div>{BODY}</div></body></html>",
        f"<body><div id='page' class='with-sidebar'><article>{BODY}</article>{ASIDES}</div></body>",
        f"<body><div id='page' class='with-sidebar'><div class='text'>{BODY}</div>{ASIDES}</div></body>",
        f"<body><article class='post has-comments'>{BODY}<div class='share'>Tell all</div></article>{ASIDES}</body>",
        f"<body><main class='search'><div class='widget'><article class='ad'>{BODY}</article></div></main>{ASIDES}",
        f"<body><div class='search-content'>{BODY}</div>{ASIDES}</body>",
        f"<body><div class='search-content'>{TEXT}</div>{ASIDES}</body>",
        f"<body><div role='main' class='menu-open'>{BODY}</div>{ASIDES}</body>",
        f"<body><article>{BODY}</article><div id='comments'><article>{'reply ' * 200}</article></div></body>",
    ],
)
def test_side_names_on_wrappers_and_articles_lose_nothing(extractor, page):
    assert extractor.extract(page) == TEXT


def test_pages_with_side_names_on_wrappers_are_labelled():
    page = f"<body class='has-sidebar'><div class='with-ads'><article class='post'>{BODY}</article>{ASIDES}</div></body>"
    found = html_text.count_features(page)
    assert found["", False, True] == 80 and found["", False, False] == 22
    assert found[".post", False, True] == 80 and not found[".sidebar", False, True]


@pytest.mark.parametrize("around", ["<article>{}</article>", "<div class=text>{}</div>", "<body>{}", "<main>{}</main><p>end"])
@pytest.mark.parametrize(
    "side",
    [
        "<aside>" + "see " * 60 + "</aside>",
        "<div class='advert'>" + "<ul><li>buy</ul>" * 90 + "</div>",
        "<form>" + "<p>name " * 500 + "</form>",
        "<div class='newsletter'><h2>News</h2>" + "mail " * 400 + "</div><div class='related'>" + "more " * 400 + "</div>",
    ],
)
@pytest.mark.parametrize(("before", "after"), [(40, 300), (300, 40)])
def test_long_side_blocks_do_not_cut_the_article(extractor, around, side, before, after):
    page = around.format(f"<p>{'early ' * before}</p>{side}<p>{'late ' * after}</p>")
    assert extractor.extract(page).removesuffix(" end") == " ".join(["early"] * before + ["late"] * after)


def test_rare_features_keep_their_weights(spark):
    def page(i):
        names = f"c{chr(97 + i % 26)}{chr(97 + i // 26)}"
        return f"<div class=x{names}>side words here</div><article><div class={names}>{i} main</div></article>"

    rows = [(i, f"u{i}", page(i), "") for i in range(60)]
    plain = "<div class=xcaa>side words here</div><div class=caa>text of the page</div>"
    rows += [(100, "a", plain, ""), (100, "a", plain, ""), (None, None, plain, ""), (101, None, None, "")]
    pages = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(str, html_text.main_text(pages).collect()))
    assert sum("text of the page" in row and "side" not in row for row in whole) == 3
    for shared_features in (0, 1, 20):
        assert sorted(map(str, html_text.main_text(pages, None, shared_features).collect())) == whole


def test_all_features_are_learned(spark):
    def name(i):
        return "".join(chr(97 + i // 26**k % 26) for k in range(4))

    body = "".join(f"<i class={name(i)}>w</i>" for i in range(25_000))
    pages = spark.createDataFrame([(1, "u", f"<article>{body}</article>", "")], SCHEMA)
    assert len(html_text.learn_weights(pages)) >= 25_000


def test_nulls_and_empty_tables(spark):
    rows = [(1, None, None, "x"), (None, "u", "<article>a b</article>", "x"), (None, "u", "<article>a b</article>", "x")]
    got = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, "", 0), (None, "a b", 3), (None, "a b", 3)]
    assert html_text.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "section",
    ["<section class='related-work'>", "<section id='menu-costs'>", "<section id=search>", "<h2 id='share'>On shares</h2>", "<div class='post-comments-policy'>"],
)
def test_sections_of_an_article_stay(extractor, section):
    page = f"<article><p>{'word ' * 80}</p>{section}<p>{'more ' * 30}</p></section></div></article><footer>end</footer>"
    text = extractor.extract(page)
    assert text.count("word") == 80 and text.count("more") == 30 and "end" not in text


def test_side_names_are_learned_beside_the_list():
    """A name that no list has, on labelled pages outside the article, then on a plain page."""
    pages = [f"<article><div class=story>{i} {'main ' * 50}</div></article><div class=responses>{'reply ' * 30}</div>" for i in range(9)]
    total = Counter()
    for page in pages:
        total.update(html_text.count_features(page))
    rows = [
        {"feature": f, "is_tag": t, "inside": total[f, t, True], "outside": total[f, t, False]}
        for f, t in {(f, t) for f, t, _ in total}
    ]
    page = f"<div class=story>{'main ' * 40}</div><div class=responses>{'reply ' * 30}</div>"
    assert html_text.Extractor(html_text._weights(rows)).extract(page) == " ".join(["main"] * 40)


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 100_000 + "word " * 50,
        "<p>" + "<b>word " * 50_000 + "</i>" * 50_000,
        "<p>" + "<i class=x>w " * 30_000 + "<hr>" * 30_000,
        "<div>" * 100_000 + "word " * 50 + "</div>" * 100_000,
        "<div class=ad>" * 50_000 + "word " * 50,
        "<article class=ad>" * 50_000 + "word " * 50,
        "<main><div class=ad>" * 30_000 + "word " * 50,
        "".join(f"<i class=n{chr(97 + i % 26) * (1 + i // 26 % 9)}{chr(97 + i // 300 % 26)}>w " for i in range(40_000)),
    ],
)
def test_deep_nesting_takes_linear_time(extractor, page):
    began = time.time()
    extractor.extract(page)
    assert time.time() - began < 2
    html_text.count_features(page)
    assert time.time() - began < 4


def _brute_region(scores):
    best, found = 0.0, (0, 0)
    for start in range(len(scores)):
        total = 0.0
        for end in range(start, len(scores)):
            total += scores[end]
            if total > best:
                best, found = total, (start, end + 1)
    return best, found


def test_scan_equals_all_regions(extractor):
    rng = random.Random(5)
    for _ in range(300):
        scores = [float(rng.randint(-6, 6)) for _ in range(rng.randint(0, 40))]
        first, last = html_text.best_region(scores)
        assert sum(scores[first:last]) == _brute_region(scores)[0]
    parts = ["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<nav>", "</nav>", "<b>", "word word ", "one <br>", "<aside>", "</aside>", "<li>"]
    for _ in range(200):
        page = html_text.read_page("".join(rng.choice(parts) for _ in range(rng.randint(1, 40))))
        scores = extractor.event_scores(page)
        first, last = html_text.best_region(scores)
        assert abs(sum(scores[first:last]) - _brute_region(scores)[0]) < 1e-9


def test_word_scores_and_counts_equal_brute_force(extractor):
    """Inherited sums against the distinct features of all elements around."""
    rng = random.Random(6)
    parts = ["<p class=a>", "</p>", "<div class='b a'>", "</div>", "<article>", "</article>", "<i id=b>", "</i>", "x y ", "<section>", "<footer>", "</footer>"]
    for _ in range(150):
        source = "".join(rng.choice(parts) for _ in range(30))
        page = html_text.read_page(source)
        extractor._score_words(page.elements)
        found, labelled = Counter(), False
        for tag, text, element in page.events:
            around, at = [], element
            while at is not None:
                around.append(at)
                at = at.parent
            features = {f for e in around for f in e.features}
            side = any(e.side for e in around)
            if not side:
                score = html_text.PLAIN_WORD + sum(
                    min(max(extractor.weights.get((f, False), 0.0), -html_text.SIDE_BOUND), html_text.MAIN_BOUND) for f in features
                )
                assert element.score == pytest.approx(min(max(score, -3.0), 3.0))
            main = any(e.main for e in around) and not side
            labelled |= main
            words = len(text.split())
            if tag:
                found[tag, True, main] += 1
            elif words:
                for f in (*features, ""):
                    found[f, False, main] += words
        assert html_text.count_features(source) == (found if labelled else Counter())
