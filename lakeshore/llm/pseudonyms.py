"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation inside each format.

Candidates are found by pattern and validated (Luhn for cards, mod 97 for
IBANs, the calendar for dates, numbering-plan rules for phones, octets for IP
addresses).  A valid value is ranked among all valid values of its format, the
rank is permuted, and the permuted rank written in the same format, so the
result is again valid, and equal values (in whatever spelling) keep one
pseudonym in every document without any shared table.  The permutation is
``P^-1(P(x) + k)`` for a Feistel network P under cycle walking: a bijection
that maps no value to itself.

A match may hold digit groups beside the value (an expiry date, a security code,
a list number).  The value is then sought between group edges, usual forms
first.  Where a pseudonym would make another span of the match valid, it is
permuted on, so there it may differ from the same value's elsewhere.  Phones of
countries with numbers of many lengths may take following groups in.

Defined cases: NULL text stays NULL; text without personal data is returned
unchanged; values that fail validation stay; repeated rows get equal results;
other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 10
#: Only for runs without a key of their own: a real corpus needs a secret.
DEFAULT_KEY = b"lakeshore-demo-key"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
KINDS = ("email", "iban", "date", "ip", "card", "ssn", "phone", "secret")

VALUE = re.compile(r"""
    (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<secret>(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])
        |(?<![A-Za-z])(?:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}["']?[A-Za-z0-9+/_-]{8,128})
  | (?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))
  | (?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-]))
  | (?P<phone>(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)
        |(?<![\d(.-])(?:\([2-9]\d{2}\)[ ]?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?![\d-]))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<card>(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-]))
""", re.X)
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)@([A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8})")
#: A card match with the digit groups after it, where a card may go on.
RUN = re.compile(r"\d+(?:[ -]\d+){0,40}")
GROUP = re.compile(r"[A-Z0-9]+")
#: Kinds whose match may hold digit groups of its neighbours.
GROUPED = ("card", "iban", "phone")
#: Digit groups that cards are written in, besides one group.
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
#: Characters of an IBAN by country.
IBAN_CHARS = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FO,GL,NL 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,HR,LI,LV 22:BG,BH,DE,GB,GE,IE,ME,RS 23:AE,GI,IL "
    "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:PT 26:IS,TR 27:FR,GR,IT,MC,SM 28:AL,AZ,CY,DO,GT,HU,LB,PL 29:BR,PS,QA 30:JO,KW,MU 31:MT").split())
    for c in cs.split(",")}
#: Digits of a phone number, country code included, by its first two digits (plans of one length or nearly so).
PHONE_DIGITS = {c: tuple(map(int, n.split("/"))) for n, cs in (x.split(":") for x in (
    "10:45,47 11:27,31,33,34,41,48,61 10/11:32 11/12:44 12:52,81,82,90,91,92,20,63 12/13:49,55,86").split())
    for c in cs.split(",")} | {f"7{d}": (11,) for d in range(10)}
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


class Permutation:
    """Keyed permutations of 0..n-1 without fixed points (n >= 2), one per kind of value."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, kind: str, n: int, turn: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{kind}|{n}|{turn}|{half}".encode(), key=self.key, digest_size=32).digest(), "big")

    def _network(self, kind: str, n: int, x: int, forward: bool) -> int:
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        while True:  # cycle walking: a * b exceeds n only a little
            left, right = divmod(x, b)
            for turn in range(ROUNDS) if forward else reversed(range(ROUNDS)):
                sign = 1 if forward else -1
                if turn % 2:
                    right = (right + sign * self._f(kind, n, turn, left)) % b
                else:
                    left = (left + sign * self._f(kind, n, turn, right)) % a
            x = left * b + right
            if x < n:
                return x

    def __call__(self, kind: str, n: int, x: int, undo: bool = False) -> int:
        if n < 2:
            return x
        shift = 1 + self._f(kind, n, -1, 0) % (n - 1)
        y = self._network(kind, n, x, True)
        return self._network(kind, n, (y + (-shift if undo else shift)) % n, False)


def luhn_digit(payload: str) -> str:
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(payload))))
    return str(-total % 10)


def _refill(shape: str, new: str, is_place=str.isdigit) -> str:
    """``shape`` with its places taken from ``new`` in order."""
    it = iter(new)
    return "".join(next(it) if is_place(c) else c for c in shape)


def _rank(values: list[int], sizes: list[int]) -> int:
    x = 0
    for v, s in zip(values, sizes):
        x = x * s + v
    return x


def _unrank(x: int, sizes: list[int]) -> list[int]:
    out = []
    for s in reversed(sizes):
        x, v = divmod(x, s)
        out.append(v)
    return out[::-1]


class Pseudonyms:
    """Replaces the validated values of a text; ``undo`` restores them with the same key."""

    def __init__(self, key: bytes = DEFAULT_KEY, undo: bool = False) -> None:
        self.permute, self.undo = Permutation(key), undo
        self._value = lru_cache(maxsize=100_000)(self._replace)

    def _digits(self, kind: str, digits: str, sizes: list[int], low: list[int]) -> str | None:
        values = [int(d) - k for d, k in zip(digits, low)]
        if any(not 0 <= v < s for v, s in zip(values, sizes)):
            return None
        moved = _unrank(self.permute(kind, prod(sizes), _rank(values, sizes), self.undo), sizes)
        return "".join(str(v + k) for v, k in zip(moved, low))

    def _classes(self, kind: str, text: str) -> str:
        """Characters permuted together, each within its class; others stay."""
        places = [(c, s) for c in text for s in CLASSES if c in s]
        moved = _unrank(self.permute(kind, prod(len(s) for _, s in places), _rank([s.index(c) for c, s in places], [len(s) for _, s in places]),
                                     self.undo), [len(s) for _, s in places]) if places else []
        return _refill(text, "".join(s[v] for v, (_, s) in zip(moved, places)), lambda c: c.isascii() and c.isalnum())

    def _replace(self, kind: str, value: str) -> str | None:
        """The pseudonym, or None where the value is not valid."""
        return getattr(self, f"_{kind}")(value)

    def _card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = self._digits("card", digits[:-1], [10] * (len(digits) - 1), [0] * (len(digits) - 1))
        return _refill(value, body + luhn_digit(body))

    def _iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
            return None
        body = self._classes("iban" + plain[:2], plain[4:])
        return _refill(value, f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}", lambda c: c != " ")

    def _date(self, value: str) -> str | None:
        sep = re.search(r"\D", value).group()
        a, b, c = value.split(sep)
        # Day before month, except after a year, and in slashes where only month-day fits or could.
        y, m, d = (a, b, c) if len(a) == 4 else (c, a, b) if sep == "/" and int(a) <= 12 else (c, b, a)
        try:
            day = datetime.date(int(y), int(m), int(d)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + self.permute("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY, self.undo))
        show = lambda v, old: f"{v:0{len(old)}d}"
        if len(a) == 4:
            return sep.join((f"{new.year:04d}", show(new.month, b), show(new.day, c)))
        first, second = (new.month, new.day) if (y, m, d) == (c, a, b) else (new.day, new.month)
        return sep.join((show(first, a), show(second, b), f"{new.year:04d}"))

    def _ip(self, value: str) -> str | None:
        try:
            number = int(ipaddress.IPv4Address(value))
        except ValueError:
            return None
        return str(ipaddress.IPv4Address(self.permute("ip", 2 ** 32, number, self.undo)))

    def _ssn(self, value: str) -> str | None:
        area, group, serial = map(int, value.split("-"))
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return None
        sizes = [898, 99, 9999]
        x = self.permute("ssn", prod(sizes), _rank([area - 1 - (area > 666), group - 1, serial - 1], sizes), self.undo)
        area, group, serial = _unrank(x, sizes)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _phone(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if value[0] != "+" or digits[0] == "1":
            own = digits[1:] if value[0] == "+" else digits
            if len(own) != 10:
                return None
            moved = self._digits("phone", own, [8, 10, 10, 8, *[10] * 6], [2, 0, 0, 2, *[0] * 6])
            if moved is None:  # outside the numbering plan: permuted among the numbers outside it
                moved = own
                while (moved := f"{self.permute('phone10', 10 ** 10, int(moved), self.undo):010d}")[0] >= "2" and moved[3] >= "2":
                    pass
            return _refill(value, digits[:len(digits) - 10] + moved)
        if not 8 <= len(digits) <= 15:
            return None
        return _refill(value, digits[:2] + self._digits("phone" + digits[:2], digits[2:], [10] * (len(digits) - 2), [0] * (len(digits) - 2)))

    def _secret(self, value: str) -> str | None:
        if value.startswith("AKIA"):
            return "AKIA" + self._classes("secret", value[4:])
        head, body = re.fullmatch(r"""(.*?[=:]\s*["']?)(.*)""", value, re.S).groups()
        return head + self._classes("secret", body) if any(c.isdigit() for c in body) else None

    def _email(self, value: str) -> str | None:
        local, _, domain = value.partition("@")
        moved = self._classes("email" + domain.lower(), local.lower())
        return f"{_same_case(local, moved)}@{domain}" if moved != local.lower() else None

    def text(self, text: str) -> tuple[str, Counter]:
        """The text with pseudonyms, and how many of each kind."""
        found: Counter = Counter()

        def put(kind: str, value: str) -> str:
            new = self._value(kind, value)
            if new is None:
                return value
            found[kind] += 1
            return new

        if "@" in text:
            text = EMAIL.sub(lambda m: put("email", m.group()), text)
        if any(d in text for d in "0123456789"):
            text = "".join(self._parts(text, put, found))
        return text, found

    def _parts(self, text: str, put, found: Counter) -> Iterator[str]:
        """The text in pieces, with pseudonyms."""
        done = at = 0
        while m := VALUE.search(text, at):
            kind, low, high = m.lastgroup, m.start(), m.end()
            if kind not in GROUPED:
                yield text[done:low] + put(kind, m.group())
                done = at = high
                continue
            value = m.group()
            if kind == "card":
                value = RUN.match(text, low).group()
            span = self._span(kind, value, high - low)
            if span is None:  # what follows the first group may be a value of its own
                at = low + GROUP.search(value).end()
                continue
            a, b = span
            yield text[done:low]
            yield from self._parts(value[:a], put, found) if a else ()
            yield self._moved(kind, value, span, high - low)
            found[kind] += 1
            done = at = low + b
        yield text[done:]

    def _span(self, kind: str, value: str, within: int) -> tuple[int, int] | None:
        """Where the valid value stands in a match, from group edge to group edge, by the first ``within`` characters' starts.

        Spans of the usual form come first, so that a neighbour which happens to
        validate together with the value takes no part in it.
        """
        for span in _spans(kind, value, within):
            if self._value(kind, value[slice(*span)]) is not None:
                return span
        return None

    def _moved(self, kind: str, value: str, span: tuple[int, int], within: int) -> str:
        """The pseudonym of the value in ``span``, permuted on while another span would be read in its place, so that ``undo`` finds it."""
        new = self._value(kind, value[slice(*span)])
        while self._span(kind, value[:span[0]] + new + value[span[1]:], within) != span:
            new = self._value(kind, new)
        return new


def _spans(kind: str, value: str, within: int) -> list[tuple[int, int]]:
    """Spans of whole groups that may be a value, the usual forms first, then by start, longest first."""
    groups = [g.span() for g in GROUP.finditer(value)]
    if kind == "phone" and value[0] != "+":
        return [(0, len(value))]
    out = []
    for i, (a, _) in enumerate(groups):
        if a >= within or kind == "phone" and i:
            break
        plain, sizes = "", []
        for c, b in groups[i:]:
            plain += value[c:b]
            sizes.append(b - c)
            if len(plain) > 34 or kind == "card" and len(plain) > 19:
                break
            if kind == "card":
                usual = len(sizes) == 1 or tuple(sizes) in CARD_GROUPS
                fits = len(plain) >= 13
            elif kind == "iban":
                usual, fits = IBAN_CHARS.get(plain[:2]) == len(plain), len(plain) >= 15 and plain[:2].isalpha() and plain[2:4].isdigit()
            else:
                usual, fits = len(plain) in PHONE_DIGITS.get(plain[:2], ()), len(plain) >= 8
            if fits:
                out.append((not usual, a, -b))
    return [(0 if kind == "phone" else a, -b) for _, a, b in sorted(out)]


def _same_case(old: str, new: str) -> str:
    return "".join(n.upper() if o.isupper() and o.isascii() else n for o, n in zip(old, new))


def pseudonymise(docs: DataFrame, key: bytes = DEFAULT_KEY, undo: bool = False) -> DataFrame:
    """doc_id, text, and one count per kind of value replaced, for every row."""
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Pseudonyms(key, undo)
        for batch in batches:
            got = [(None, Counter()) if t is None else work.text(t) for t in batch.column(1).to_pylist()]
            counts = [pa.array([c[k] for _, c in got], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in got], pa.string()), *counts],
                                             names=["doc_id", "text", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, " + ", ".join(f"{n} long" for n in names))
