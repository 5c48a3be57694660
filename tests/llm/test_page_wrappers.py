"""Pages whose layout names, short blocks or several articles must not cost any of the main text."""

import pytest

from basketry.llm import html_text

TEXT = "A sentence of the article that is long enough to stand out from all that surrounds it on the page."
BODY = "".join(f"<p>{i} {TEXT}</p>" for i in range(5))
BLOCKS = [f"{i} {TEXT}" for i in range(5)]
ASIDE = f"<div class=sidebar><p>{TEXT}</p></div><section class=related><p>{TEXT}</p></section>"


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div id=page class=no-ads", "div class='post share-enabled'", "section class=related-topic", "span class=widget"])
def test_a_wrapper_with_a_surrounding_name_keeps_its_text(wrapper):
    end = wrapper.split()[0]
    for inner in (BODY, f"<article>{BODY}</article>", f"<main>{BODY}</main>"):
        assert html_text.main_blocks(f"<body>{ASIDE}<{wrapper}>{inner}</{end}>{ASIDE}</body>") == BLOCKS


def test_named_surroundings_still_go():
    comments = "".join(f"<div class=comment><p>{TEXT} {TEXT} says {i}</p></div>" for i in range(40))
    teaser = f"<div class=related><article><p>{TEXT}</p></article></div>"
    for inner in (f"<div>{BODY}</div>", f"<article>{BODY}</article>", f"<div class='post has-sidebar'>{BODY}</div>"):
        assert html_text.main_blocks(f"<body>{ASIDE}{inner}{teaser}<section id=comments>{comments}</section></body>") == BLOCKS
    assert html_text.main_blocks(f"<article>{BODY}<p>x <span class=ad>buy</span> y</p></article>") == [*BLOCKS, "x y"]


def test_a_wrapper_named_after_comments_keeps_its_text():
    assert html_text.main_blocks(f"<body><div class='post comment-closed'>{BODY}</div>{ASIDE}</body>") == BLOCKS


def test_short_blocks_and_links_of_the_region_stay():
    short = "".join(f"<li>item {i} end</li>" for i in range(8))
    items, long = [f"item {i} end" for i in range(8)], [f"{i} {TEXT} {TEXT} {TEXT}" for i in range(10)]
    paragraphs = "".join(f"<p>{p}</p>" for p in long)
    linked = f"<p><a href=/x>{TEXT}</a></p>"
    found = html_text.main_blocks(f"<body>{ASIDE}<div><ul>{short}</ul>{paragraphs}{linked}<p>{TEXT}</p><ul>{short}</ul></div></body>")
    assert found == [*items, *long, TEXT, TEXT, *items]


def test_clusters_choose_among_articles():
    parts = f"<article>{BODY}</article><div class=ad><p>{TEXT}</p></div><article><h2>Part two</h2><p>{TEXT}</p></article>"
    assert html_text.main_blocks(f"<body><div>{parts}</div></body>") == [*BLOCKS, "Part two", TEXT]
    teaser = "<article><p>Short teaser of another page.</p></article>"
    assert html_text.main_blocks(f"<body><div>{BODY}</div>{teaser}</body>") == BLOCKS
