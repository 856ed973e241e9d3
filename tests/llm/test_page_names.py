"""Words for menus and the like in the names of blocks that hold the article."""

import pytest

from plumbline.llm import pagetext

SF_DIR = "/root/testdata/sf0.001"
BODY = "<h1>A title</h1><p>" + "</p><p>".join(f"This is sentence {i} of a long article. It goes on for a while." for i in range(8)) + "</p>"
WANT = "\n".join(["A title", *(f"This is sentence {i} of a long article. It goes on for a while." for i in range(8))])


@pytest.fixture(scope="module")
def models(spark):
    return pagetext.Model(pagetext.FIRST, pagetext.FIRST_EDGES), pagetext.fitted(spark.read.parquet(f"{SF_DIR}/pages.parquet"))


@pytest.mark.parametrize(
    "wrapper",
    ["div class='content no-sidebar'", "div class='post has-comments'", "div class='layout-with-sidebar'", "div class='page-header-fixed'", "section class='search-result'", "div class='widget'"],
)
def test_names_do_not_hide_the_article(models, wrapper):
    page = f"<html><body><nav><a href=x>Home</a></nav><{wrapper}>{BODY}</{wrapper.split()[0]}><div class=cookie-notice>We use cookies. Fine?</div><footer>end</footer>"
    for model in models:
        assert model.main_text(page) == WANT


def test_a_paragraph_of_the_article_with_such_a_name_stays(models):
    for model in models:
        page = f"<html><body><article>{BODY}<p class='notice-text'>A note that belongs to it. Read it well.</p></article>"
        assert model.main_text(page) == WANT + "\nA note that belongs to it. Read it well."


def test_small_blocks_with_such_a_name_are_no_content(models):
    for model in models:
        page = f"<html><body><article>{BODY}<div class=ad><p>Buy this now. It is good.</p></div><section id=comments><p>Nice post. Thanks.</p></section></article>"
        assert model.main_text(page) == WANT


def test_many_comments_beside_an_article_are_no_content(models):
    comments = "<p>Nice post. I like it very much, thanks.</p>" * 60
    for model in models:
        page = f"<html><body><article>{BODY}</article><section id=comments>{comments}</section>"
        assert model.main_text(page) == WANT
