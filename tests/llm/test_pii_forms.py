"""Personal data in further ordinary forms: linked with the same values, and back again."""

from __future__ import annotations

import re

import pytest

from corpusloom.llm import pii

CIPHER = pii.Feistel(b"key")


@pytest.mark.parametrize("text", ["at 2024-01-02T10:00:05Z", "on 2024/01/02.", "on 02-01-2024,"])
def test_dates(text):
    new, counts = pii.pseudonymise(text, CIPHER)
    assert counts["date"] == 1 and pii.pseudonymise(new, CIPHER, back=True)[0] == text
    base = pii.pseudonymise("2024-01-02", CIPHER)[0].split("-")
    found = re.findall(r"\d+", new)[:3]
    assert found in (base, base[::-1])


@pytest.mark.parametrize("body", ["222100000000000", "272099999999999", "250012345678901"])
def test_cards_of_the_two_series(body):
    card = next(body + str(d) for d in range(10) if pii.luhn(body + str(d)) == 0)
    new, counts = pii.pseudonymise(f"card {card}", CIPHER)
    assert counts["card"] == 1 and new[5:] != card and pii.luhn(new[5:]) == 0 and 2221 <= int(new[5:9]) <= 2720
    assert pii.pseudonymise(new, CIPHER, back=True)[0] == f"card {card}"
    assert pii.pseudonymise(f"card 2000{card[4:]}", CIPHER)[1]["card"] == 0


@pytest.mark.parametrize("text", ["on Jan 2, 2024.", "2 January 2024", "JANUARY 2 2024", "2 Jan. 2024", "(Sept 30, 1999)"])
def test_written_dates(text):
    new, counts = pii.pseudonymise(text, CIPHER)
    assert counts["date"] == 1 and new != text
    if "2024" in text:
        year, month, day = pii.pseudonymise("2024-01-02", CIPHER)[0].split("-")
        assert year in new and pii.MONTHS[int(month) - 1][:3].lower() in new.lower() and str(int(day)) in re.findall(r"\d+", new)


@pytest.mark.parametrize("text", ["2024 May", "May 2024", "32 January 2024", "Feb 30, 2023", "March of 2024", "12 Marches 2024"])
def test_no_dates(text):
    assert pii.pseudonymise(text, CIPHER)[0] == text


@pytest.mark.parametrize("text", ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "at 2001:db8::ff00:42:8329.", "fe80::1", "2001:DB8::1"])
def test_ip6(text):
    new, counts = pii.pseudonymise(text, CIPHER)
    assert counts["ip"] == 1 and new != text and len(new) == len(text) and pii.pseudonymise(new, CIPHER, back=True)[0] == text


@pytest.mark.parametrize("text", ["12:30:45", "std::vector", "a::b", "1::2", "10:20", "::"])
def test_no_ip6(text):
    assert pii.pseudonymise(text, CIPHER)[0] == text


def test_telephones_in_several_layouts():
    digits = lambda t: re.sub(r"\D", "", t)[-10:]
    forms = ["415 555 0100", "(415) 555-0100", "415.555.0100", "+1 415 555 0100", "+14155550100", "415-555-0100"]
    moved = [pii.pseudonymise(f"call {t} now", CIPHER) for t in forms]
    assert {digits(t) for t, _ in moved} == {digits(moved[0][0])} != {digits(forms[0])} and all(c["phone"] == 1 for _, c in moved)
    for same in ("415 555 0100 22", "12 415 555 0100", "115 555 0100", "415 155 0100"):
        assert pii.pseudonymise(same, CIPHER)[0] == same
