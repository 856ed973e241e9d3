"""Elements that are no part of an article, at any depth, and markup that is broken."""

import time

import pytest

from plumbline.llm import pagetext

SF_DIR = "/root/testdata/sf0.001"
SENTENCES = [f"This is sentence {i} of a long article. It goes on for a while." for i in range(8)]
BODY = "<h1>A title</h1><p>" + "</p><p>".join(SENTENCES) + "</p>"
WANT = "\n".join(["A title", *SENTENCES])
OTHER = "Some words that stand elsewhere. They are sentences, and not few. They go on and on."


@pytest.fixture(scope="module")
def models(spark):
    return pagetext.Model(pagetext.FIRST, pagetext.FIRST_EDGES), pagetext.fitted(spark.read.parquet(f"{SF_DIR}/pages.parquet"))


@pytest.mark.parametrize("depth", [1, 2, 3, 6])
@pytest.mark.parametrize("outer", ["aside", "footer", "nav", "section id=comments", "form", "dialog"])
def test_nothing_below_an_observed_block_is_content(models, outer, depth):
    inner = "".join(["<div>"] * (depth - 1)) + f"<p>{OTHER}</p>" + "</div>" * (depth - 1)
    for wrapped in (f"<article>{BODY}</article>", f"<div>{BODY}</div>"):
        page = f"<html><body>{wrapped}<{outer}>{inner}</{outer.split()[0]}></body></html>"
        for model in models:
            assert model.main_text(page) == WANT
    listed = f"<html><body><article>{BODY}</article><nav><ul><li><p>{OTHER}</ul></nav>"
    assert all(model.main_text(listed) == WANT for model in models)


def test_a_form_around_the_page_is_no_form_of_the_page(models):
    controls = "<label>Your name</label><input><select><option>One<option>Two</select><button>Go</button>"
    for model in models:
        assert model.main_text(f"<body><form>{BODY}</form>") == WANT
        assert model.main_text(f"<body><article>{BODY}</article><form><p><label>Write here</label>{controls}</p></form>") == WANT


def test_the_header_of_an_article_keeps_its_headline(models):
    page = f"<body><header><p>{OTHER}</header><article><header><h1>A title</h1></header>{BODY[len('<h1>A title</h1>'):]}</article>"
    for model in models:
        assert model.main_text(page) == WANT


def test_an_element_left_open_does_not_swallow_the_article(models):
    for model in models:
        assert model.main_text(f"<body><nav><a href=x>Home</a><main>{BODY}</main>") == WANT


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<article>{BODY}<p class="x>Broken, but it is a sentence.</article>', f"{WANT}\nBroken, but it is a sentence."),
        (f"<article>{BODY}<p title='it>Broken, but it is a sentence.", f"{WANT}\nBroken, but it is a sentence."),
        (f"<article>{BODY}<p>One < two, and that is a sentence.</p><p unfinished", f"{WANT}\nOne < two, and that is a sentence."),
        (f"<article>{BODY}</p></section></b><!-- open", WANT),
    ],
)
def test_broken_markup_is_no_text(models, page, want):
    for model in models:
        assert model.main_text(page) == want


@pytest.mark.parametrize(
    "noise",
    ["<div>" * 25_000 + "</section>" * 90_000, "<option>" * 125_000, "<li><svg>" * 100_000, "</p>" * 250_000, "<table><tr><td>" * 60_000, "<a href='" * 110_000],
)
def test_a_megabyte_of_unmatched_tags_takes_no_long_time(noise):
    began = time.process_time()
    pagetext.blocks_of(f"<body>{noise}")
    assert time.process_time() - began < 4
