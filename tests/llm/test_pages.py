import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import pages

TEXT = "This is the article itself, a paragraph long enough to be read as text by any measure of words."


@pytest.mark.parametrize("page", [
    f'<body class="page with-sidebar"><article><p>{TEXT}</p></article></body>',
    f'<body class="home nav-open"><article><p>{TEXT}</p></article></body>',
    f'<div class="content no-sidebar"><p>{TEXT}</p></div>',
    f'<div class="sidebar-layout"><main><p>{TEXT}</p></main></div>',
    f'<html id="menu"><body class="ad"><article><p>{TEXT}</p></article>',
])
def test_the_name_of_an_outer_element_never_empties_a_page(page):
    assert pages.main_text(page) == TEXT


@pytest.mark.parametrize("part", [
    '<nav><a href=x>One</a> <a href=y>Two</a></nav>', '<header>Site name and its motto</header>', '<footer>All rights</footer>',
    '<aside>Other things to read here</aside>', '<div class="ad">Buy this now</div>', '<form>Your name <input></form>',
    '<div class="cookie-notice">We use them</div>', '<script>var a = "<p>";</script>', "<style>p{}</style>",
    '<section class="comments"><article class="comment"><p>I disagree with all of this, said a reader.</p></article></section>',
    '<section id="comments"><article><p>I disagree with all of this, said a reader at length.</p></article></section>',
    '<ul><li><a href=a>Home page</a></li><li><a href=b>News</a></li><li><a href=c>Contact</a></li><li><a href=d>About us</a></li></ul>',
])
def test_other_parts_of_an_article_are_left_out(part):
    page = f"<article><h1>Title of it</h1><p>{TEXT}</p>{part}<p>{TEXT}</p></article>"
    kept = pages.main_text(page).split("\n")
    if part.startswith("<ul>"):  # the ends of a list stand beside text
        assert "News" not in kept and "Contact" not in kept
        kept = [k for k in kept if k not in ("Home page", "About us")]
    assert kept == ["Title of it", TEXT, TEXT]


def test_elements_that_the_contract_does_not_name_stay():
    page = f"<article><p>{TEXT}</p><p>Then <math><mi>x</mi><mo>=</mo><mn>2</mn></math> follows and is read as part of the text.</p><object>Fallback words of an object that can't be shown.</object></article>"
    assert pages.main_text(page).split("\n") == [TEXT, "Then x=2 follows and is read as part of the text.", "Fallback words of an object that can't be shown."]


def _slow_state(page):
    """The flags of the blocks of tags without attributes, by walking all open elements."""
    out, stack = [], []
    for tag in page:
        if tag.startswith("</"):
            if tag[2:-1] in stack:
                while stack.pop() != tag[2:-1]:
                    pass
        elif tag.startswith("<"):
            stack.append(tag[1:-1])
        else:
            out.append((tag, any(s in pages.ARTICLE for s in stack), any(s in pages.ASIDE for s in stack)))
    return out


def test_flags_equal_a_walk_over_the_stack():
    draw = np.random.default_rng(1)
    names = ["div", "section", "article", "nav", "aside", "main", "footer"]
    for _ in range(300):
        page = []
        for k in range(40):
            page += [f"<{'/' if draw.random() < 0.45 else ''}{draw.choice(names)}>", f"w{k}"]
        assert [(b[0], b[3], b[4]) for b in pages.blocks("".join(page))] == _slow_state(page)


def test_deep_nesting_takes_linear_time():
    def seconds(n):
        start = time.perf_counter()
        assert len(pages.main_text("<div>a" * n).split("\n")) <= n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4000), 0.01)
    assert len(list(pages.blocks("<li>a<dt>b" * 20_000))) == 40_000


def test_the_tree_cuts_where_impurity_is_least():
    rows = np.array([[1, 5], [2, 5], [3, 1], [4, 1.0]])
    assert pages.grow(rows, np.array([0, 0, 1, 1.0]), 3) == (0, 2.5, 0.0, 1.0)
    assert pages.grow(rows, np.ones(4), 3) == 1.0
    assert pages.grow(np.ones((4, 2)), np.array([0, 0, 0, 1.0]), 3) == 0.25
    assert pages.grow(rows, np.array([0, 1, 0, 1.0]), 1) == (0, 1.5, 0.0, 2 / 3)


def test_labelled_blocks_are_learned_and_words_and_links_decide():
    data = np.array(pages.LABELLED, float)
    assert all(pages._is_main(pages.tree(), tuple(row[:-1])) == bool(row[-1]) for row in data)
    used = set()

    def walk(node):
        if isinstance(node, tuple):
            used.add(pages.FEATURES[node[0]])
            walk(node[2])
            walk(node[3])

    walk(pages.tree())
    assert {"links", "place"} < used
    right = 0
    for k in range(len(data)):  # each labelled block by a tree of the others
        left = np.delete(data, k, axis=0)
        right += pages._is_main(pages.grow(left[:, :-1], left[:, -1], 6), tuple(data[k, :-1])) == bool(data[k, -1])
    assert right >= 0.75 * len(data)


def test_empty_tables_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", f"<article><p>{TEXT}"), (1, "u", f"<article><p>{TEXT}"), (None, None, None)], "page_id long, url string, html string")
    df = df.withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    out = pages.extracted(df)
    assert out.columns == ["page_id", "url", "html", "n_chars", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", TEXT, TEXT]
    assert pages.extracted(df.limit(0)).count() == 0
