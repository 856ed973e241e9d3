"""Addresses and numbers whose disguises are mixed."""

import pytest

from plumbline.llm import pii


def values(text):
    detector = pii.Detector()
    (sign,) = detector.disguised([text])
    return [(k, text[s:e], v) for k, s, e, plain, v in detector.spans(text, sign) if not plain]


@pytest.mark.parametrize(
    ("source", "value"),
    [
        ("jane [at] example dot com", "jane@example.com"),
        ("jane (at) example dot org", "jane@example.org"),
        ("jane@example dot com", "jane@example.com"),
        ("jane @ mail dot example.travel", "jane@mail.example.travel"),
        ("jane at example [dot] com", "jane@example.com"),
        ("jane at mail.example dot org", "jane@mail.example.org"),
        ("jane at firm dot ca", "jane@firm.ca"),
        ("jane dot doe at firm dot co dot jp", "jane.doe@firm.co.jp"),
        ("jane [at] firm [dot] museum", "jane@firm.museum"),
    ],
)
def test_mixed_addresses(source, value):
    assert values(f"Write: {source}, please") == [("email", source, value)]


@pytest.mark.parametrize(
    ("source", "value"), [("+44 seven 700 900 123", "+44 7 700 900 123"), ("+44 7700 nine 00 123", "+44 7700 9 00 123")]
)
def test_one_spelled_digit(source, value):
    assert values(f"Call {source}!") == [("phone", source, value)]


def test_bracketed_dots_between_spelled_digits():
    source = "one nine two (dot) one six eight (dot) zero (dot) one"
    assert values(f"At {source} there") == [("ip", source, "192.168.0.1")]


@pytest.mark.parametrize("text", ["look at this dot in the picture", "the one 5 of us", "meet me at example.com", "at noon @ home dot"])
def test_ordinary_words(text):
    assert values(text) == []
