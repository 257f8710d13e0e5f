"""Random strings of all character classes, and strings that are none."""

from __future__ import annotations

import pytest
from meterflow.llm import secrets


@pytest.mark.parametrize("text", [
    "KEY=9F86D081884C7D659A2FEAA0C55AD015", "x7f3k9q2m5z8w1p4r6t0b", "K2J7Q4XWZ5TNB3RYC6MDA",
    "qXwZkTjRbVnMpLsDfGhJcK", "qxzkjvwpmbtrhdlcgnfsxk"])
def test_random_strings_are_found(text):
    assert secrets.entropy_spans(f"a {text} b") == [(2, 2 + len(text))]


@pytest.mark.parametrize("text", [
    "Donaudampfschifffahrtsgesellschaft", "internationalization-of-everything",
    "my-article-2024-about-something-nice", "id=123e4567-e89b-12d3-a456-426614174000",
    "getUserAccountInformationFromServer", "/usr/local/lib/python3/site-packages/numpy", "0" * 30])
def test_words_and_identifiers_are_not(text):
    assert secrets.entropy_spans(text) == []
