"""Values next to other tokens are found, and come back."""

from __future__ import annotations

import pytest
from meterflow.llm import pii

FEISTEL = pii.Feistel(b"key")


def made(text):
    out, _ = pii.pseudonymised(text, FEISTEL)
    assert pii.pseudonymised(out, FEISTEL, back=True)[0] == text
    return out


@pytest.mark.parametrize("value,after", [
    ("DE89 3704 0044 0532 0130 00", " BIC COBADEFF"), ("+1 (743) 555-3824", " 2024"),
    ("+1 (743) 555-3824", " 2 times"), ("+1 (743) 555-3824", " 2024-13-01"), ("+49 30 1234567", " 2024 12345")])
def test_value_before_other_tokens(value, after):
    alone = made(value)
    assert alone != value and made(value + after) == alone + after


def test_two_ibans_and_a_phone_before_a_date():
    assert "0532" not in made("GB82 WEST 1234 5698 7654 32 DE89 3704 0044 0532 0130 00 x")
    assert not made("+1 (743) 555-3824 2024-01-05").startswith("+1 (743)")


def test_month_first_dates():
    assert all(made(f"on 12/{day}/{year}") != f"on 12/{day}/{year}" for day in (13, 25, 31) for year in range(1990, 2030))
