"""IBANs followed by something that the pattern takes in as well."""

from __future__ import annotations

import pytest

from daylake.llm import pii

DE, GB = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"


@pytest.mark.parametrize(
    ("text", "masked"),
    [
        (f"{DE} BIC: COBADEFF", "[IBAN] BIC: COBADEFF"),
        (f"{GB.replace(' ', '')} A note", "[IBAN] A note"),
        (f"{GB} 2024-01-02", "[IBAN] 2024-01-02"),
        (f"{DE} {GB} X", "[IBAN] [IBAN] X"),
        (f"AB12 3456 7890 123 {DE} ok", "AB12 3456 7890 123 [IBAN] ok"),
        (f"{DE[:-1]}1 BIC", f"{DE[:-1]}1 BIC"),
    ],
)
def test_an_iban_ends_at_its_length(text, masked):
    assert pii.mask(text) == masked


def test_an_unknown_country_is_tried_at_each_end_of_a_word():
    body = "00001111222233334444"
    check = 98 - int(body + "3333" + "00") % 97  # XX is 33 33
    assert pii.mask(f"XX{check:02d} {body} AND 12 more") == "[IBAN] AND 12 more"
