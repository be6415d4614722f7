"""Personal data under format-preserving Feistel pseudonyms.

A validated value is ranked within its format (the digits or letters that may change, or the days
of a calendar), moved by a keyed permutation of that range and written back in the same layout. The
permutation is P^-1(P(x) + 1) with P a Feistel network that walks cycles, so no value stays as it
is, equal values get equal pseudonyms in all documents, and the key undoes it.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import math
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The names of the months.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
ROUNDS = 8


class Feistel:
    """A keyed permutation of range(n) for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self._round = lru_cache(maxsize=65536)(self._mix)

    def _mix(self, tweak: str, k: int, value: int) -> int:
        data = f"{tweak}|{k}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def _walk(self, x: int, n: int, tweak: str, back: bool) -> int:
        a = max(2, math.isqrt(n - 1) + 1)
        tweak = f"{tweak}|{n}"
        while True:
            left, right = divmod(x, a)
            for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    left, right = (right - self._round(tweak, k, left)) % a, left
                else:
                    left, right = right, (left + self._round(tweak, k, right)) % a
            x = left * a + right
            if x < n:
                return x

    def move(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        return self._walk((self._walk(x, n, tweak, False) + (-1 if back else 1)) % n, n, tweak, True)


def _places(values: list[int], sizes: list[int], cipher: Feistel, tweak: str, back: bool) -> list[int]:
    x, n = 0, 1
    for v, s in zip(values, sizes, strict=True):
        x, n = x * s + v, n * s
    x = cipher.move(x, n, tweak, back)
    out = []
    for s in reversed(sizes):
        x, v = divmod(x, s)
        out.append(v)
    return out[::-1]


def luhn(digits: str) -> int:
    """0 for numbers with a right check digit."""
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10


def _fill(layout: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in layout)


def _card(text: str, cipher: Feistel, back: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    two = len(digits) == 16 and 2221 <= int(digits[:4]) <= 2720
    if not (13 <= len(digits) <= 19 and (digits[0] in "3456" or two) and len(set(digits)) > 1):
        return None
    rest = luhn(digits)
    if two:
        if rest:
            return None
        series, *tail = _places([int(digits[:4]) - 2221, *map(int, digits[4:-1])], [500] + [10] * 11, cipher, "card2", back)
        body = f"{series + 2221}" + "".join(map(str, tail))
        return _fill(text, body + next(str(d) for d in range(10) if luhn(body + str(d)) == 0))
    if rest and not (len(digits) == 16 and digits[0] in "45"):
        return None
    body = digits[0] + "".join(map(str, _places([int(c) for c in digits[1:-1]], [10] * (len(digits) - 2), cipher, f"card{digits[0]}{rest}", back)))
    return _fill(text, body + next(str(d) for d in range(10) if luhn(body + str(d)) == rest))


def _grouped(kind: str, text: str, keep: int, cipher: Feistel, back: bool) -> str:
    """Moves all digits but the first ``keep``; the first digit of an area or exchange code stays
    within 2-9 or 0-1. A number of ten digits moves alike with +1 before it and without."""
    digits = re.sub(r"\D", "", text)
    head, tail = digits[:keep], digits[keep:]
    fixed = {0, 3} if kind == "phone" and len(tail) == 10 else set()
    values, sizes, lows = [], [], []
    for k, c in enumerate(tail):
        low = (2 if c in "23456789" else 0) if k in fixed else 0
        lows.append(low)
        sizes.append((8 if low else 2) if k in fixed else 10)
        values.append(int(c) - low)
    moved = _places(values, sizes, cipher, f"{kind}{'' if head == '1' and len(tail) == 10 else head}{lows}", back)
    return _fill(text, head + "".join(str(v + low) for v, low in zip(moved, lows, strict=True)))


def _phone(text: str, cipher: Feistel, back: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    if text.startswith("+"):
        if not 8 <= len(digits) <= 15:
            return None
        return _grouped("phone", text, max(1, len(digits) - 10), cipher, back)
    return _grouped("phone", text, 0, cipher, back) if len(digits) == 10 else None


def _ssn(text: str, cipher: Feistel, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    a, g, s = _places([areas.index(area), group - 1, serial - 1], [len(areas), 99, 9999], cipher, "ssn", back)
    return f"{areas[a]:03d}-{g + 1:02d}-{s + 1:04d}"


def _ip6(text: str, cipher: Feistel, back: bool) -> str | None:
    """Each written group moves among those of as many hex digits; a double colon stays."""
    groups = re.findall("[0-9A-Fa-f]+", text)
    if len(groups) < 2 or len(groups) == 2 and len(groups[0]) < 4:
        return None
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    moved = _places([int(g, 16) for g in groups], [16 ** len(g) for g in groups], cipher, f"ip6{[len(g) for g in groups]}{re.sub('[0-9A-Fa-f]', '', text)}", back)
    upper = text != text.lower()
    it = iter(f"{v:0{len(g)}{'X' if upper else 'x'}}" for v, g in zip(moved, groups, strict=True))
    return re.sub("[0-9A-Fa-f]+", lambda _: next(it), text)


def _ip(text: str, cipher: Feistel, back: bool) -> str | None:
    if ":" in text:
        return _ip6(text, cipher, back)
    parts = text.split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts):
        return None
    return ".".join(map(str, _places(list(map(int, parts)), [256] * 4, cipher, "ip", back)))


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(text: str, cipher: Feistel, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = plain[4:]
    sizes = [10 if c.isdigit() else 26 for c in body]
    moved = _places([int(c) if c.isdigit() else ord(c) - 65 for c in body], sizes, cipher, f"iban{plain[:2]}", back)
    body = "".join(str(v) if s == 10 else chr(65 + v) for v, s in zip(moved, sizes, strict=True))
    check = 98 - _mod97(f"{plain[:2]}00{body}")
    it = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in text)


@lru_cache(maxsize=32)
def _calendar(year_digits: int, month_digits: int, day_digits: int, late: bool) -> list[int]:
    """The days that a layout can write: one digit holds 1-9 only; ``late``: days after the 12th,
    as in dates whose month comes first for certain."""
    first, last = (1900, 2099) if year_digits == 4 else (1950, 2049)
    days = (datetime.date.fromordinal(k) for k in range(datetime.date(first, 1, 1).toordinal(), datetime.date(last, 12, 31).toordinal() + 1))
    return [d.toordinal() for d in days if d.month < 10**month_digits and d.day < 10**day_digits and (d.day > 12 or not late)]


def _written_date(text: str, cipher: Feistel, back: bool) -> str | None:
    """A date with the month's name is the day that it names, so it moves as 2024-01-02 does. The order
    and the short or long name stay; the day has no leading zero."""
    month, (day, year) = re.search("[A-Za-z]+", text)[0], re.findall(r"\d+", text)[:2]
    name = next(n for n in MONTHS if n.lower().startswith(month.lower()[:3]))
    try:
        at = datetime.date(int(year), MONTHS.index(name) + 1, int(day)).toordinal()
    except ValueError:
        return None
    days = _calendar(4, 2, 2, False)
    if (k := bisect_left(days, at)) == len(days) or days[k] != at:
        return None
    moved = datetime.date.fromordinal(days[cipher.move(k, len(days), "date422False", back)])
    new = MONTHS[moved.month - 1]
    new = new if len(month) == len(name) else new[:3]
    new = new.upper() if month.isupper() else new
    numbers = iter((str(moved.day), f"{moved.year:04d}"))
    return re.sub(r"[A-Za-z]+|\d+", lambda m: next(numbers) if m[0].isdigit() else new, text)


def _date(text: str, cipher: Feistel, back: bool) -> str | None:
    if any(c.isalpha() for c in text):
        return _written_date(text, cipher, back)
    a, sep, b, _, c = re.split(r"([-/.])", text)
    year_first = len(a) == 4
    y, m, d = (a, b, c) if year_first else (c, b, a)
    swapped = not year_first and sep == "/" and int(m) > 12 >= int(d)
    if swapped:
        m, d = d, m
    try:
        day = datetime.date(int(y) if len(y) == 4 else 1950 + (int(y) - 50) % 100, int(m), int(d)).toordinal()
    except ValueError:
        return None
    days = _calendar(len(y), len(m), len(d), swapped)
    if (at := bisect_left(days, day)) == len(days) or days[at] != day:
        return None
    moved = datetime.date.fromordinal(days[cipher.move(at, len(days), f"date{len(y)}{len(m)}{len(d)}{swapped}", back)])
    year, month, dom = f"{moved.year:04d}"[-len(y) :], f"{moved.month:0{len(m)}d}", f"{moved.day:0{len(d)}d}"
    if year_first:
        return sep.join((year, month, dom))
    return sep.join((month, dom, year) if swapped else (dom, month, year))


def _email(text: str, cipher: Feistel, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    sizes = [10 if c.isdigit() else 26 for c in local if c.isascii() and c.isalnum()]
    values = [int(c) if c.isdigit() else ord(c.lower()) - 97 for c in local if c.isascii() and c.isalnum()]
    if not sizes:
        return None
    it = iter(zip(_places(values, sizes, cipher, f"email{domain.lower()}", back), sizes, strict=True))

    def write(c: str) -> str:
        if not (c.isascii() and c.isalnum()):
            return c
        v, s = next(it)
        return str(v) if s == 10 else chr((65 if c.isupper() else 97) + v)

    return "".join(map(write, local)) + "@" + domain


_FINDERS = {
    "email": re.compile(r"(?a)(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-])"),
    "iban": re.compile(r"(?a)(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "card": re.compile(r"(?a)(?<![\w.+-])[2-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])|(?<![\w.+-])3\d{3}[ -]?\d{6}[ -]?\d{5}(?![\w-])"),
    "ssn": re.compile(r"(?a)(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])"),
    "phone": re.compile(r"(?a)(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])|(?<![\w(+])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?![\w-])|(?<![\w(+.-])(?<!\d )[2-9]\d\d [2-9]\d\d \d{4}(?![\w-]| \d)"),
    "ip": re.compile(r"(?a)(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w-]|\.\d)|(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\w:])"),
    "date": re.compile(
        r"(?a)(?<![\w./-])(?:\d{4}-\d\d?-\d\d?|\d{4}/\d\d?/\d\d?|\d\d?-\d\d?-\d{4}|\d\d?/\d\d?/(?:\d{4}|\d\d)|\d\d?\.\d\d?\.(?:\d{4}|\d\d))(?:(?=T\d\d:?\d\d)|(?![\w/-]|\.\d))"
        rf"|(?<!\w)(?i:{_MONTH})\.? [0-3]?\d,? \d{{4}}(?!\w)|(?<![\w.,/-])[0-3]?\d (?i:{_MONTH})\.?,? \d{{4}}(?!\w)"
    ),
}
_MOVERS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date}
_DIGIT = re.compile("[0-9]")


def pseudonymise(text: str, cipher: Feistel, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with all validated values moved, and how many of each kind. Where values of two
    kinds overlap, the kind that ``KINDS`` names first has it."""
    counts = dict.fromkeys(KINDS, 0)
    if not _DIGIT.search(text) and "@" not in text:
        return text, counts
    taken: list[tuple[int, int, str]] = []
    for kind in KINDS:
        if kind == "email" and "@" not in text:
            continue
        mine = []
        for m in _FINDERS[kind].finditer(text):
            s, e = m.span()
            if (new := _MOVERS[kind](m[0], cipher, back)) is not None:
                mine.append((s, e, new))
        if mine:
            held = sorted(taken)
            k, kept = 0, []
            for s, e, new in mine:
                while k < len(held) and held[k][1] <= s:
                    k += 1
                if k == len(held) or held[k][0] >= e:
                    kept.append((s, e, new))
            counts[kind] += len(kept)
            taken += kept
    out, at = [], 0
    for s, e, new in sorted(taken):
        out += [text[at:s], new]
        at = e
    return "".join([*out, text[at:]]), counts


def pseudonymise_pii(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` under pseudonyms, and a column n_<kind> for each kind of value.

    A null text stays null and counts as empty; other columns pass through, but for own columns
    named n_<kind>, which these replace. Repeated rows get equal texts. Texts are read whole, of any
    length; of values of one kind that overlap the one that begins first counts. A date is linked over
    layouts that write two digits for day and month and four for the year, or the month's name; a
    telephone number over its separators and with +1 or without. Left alone: dates without a year,
    ordinals, names of months in other languages, addresses whose letters are not ASCII.
    """
    out = [c for c in docs.columns if c not in {f"n_{k}" for k in KINDS}]
    schema = StructType(list(docs.select(*out).schema.fields))
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")
    at = out.index(text_col)

    def run(batches):
        cipher = Feistel(key.encode())
        for batch in batches:
            texts, counts = [], []
            for value in batch.column(at):
                text = value.as_py()
                new, found = pseudonymise(text or "", cipher)
                texts.append(new if text is not None else None)
                counts.append(found)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS)], [*out, *(f"n_{k}" for k in KINDS)])

    return docs.select(*(F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in out)).mapInArrow(run, schema)
