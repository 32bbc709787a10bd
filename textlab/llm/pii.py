"""Operator 10, PII: format-preserving Feistel pseudonyms.

Personal numbers and dates are found in the text, validated (check digits,
ranges, calendar) and replaced by another valid value of the same format and
length.  The replacement is a keyed permutation of all values of that format
(a Feistel network over the mixed-radix value, with cycle walking), so equal
values get equal pseudonyms in every document, different values stay
different, and the key's owner can reverse it.  What fails validation stays.

Texts are handled row by row inside tasks; there is no shuffle.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 10
KINDS = ("email", "iban", "ipv4", "date", "ssn", "phone", "card")

#: One alternative for each kind, tried in this order at each position.  IBANs
#: and phone numbers take all groups that may belong; :func:`_end` cuts them.
PATTERN = re.compile(
    r"(?P<email>(?<![\w.%+-])[\w%+-][\w.%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9]))"
    r"|(?P<ipv4>(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[A-Za-z0-9]))"
    r"|(?P<date>(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"|[0-9]{1,2}(?P<date_sep>[./-])[0-9]{1,2}(?P=date_sep)[0-9]{4})"
    r"(?:(?=T[0-2][0-9](?:Z|:?[0-5][0-9]|(?![A-Za-z0-9])))|(?![./-]?[A-Za-z0-9])))"
    r"|(?P<ssn>(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[A-Za-z0-9]))"
    r"|(?P<phone>(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]){4,24}"
    r"|\([0-9]{3}\)[ .-]?[0-9]{3}[.-][0-9]{4}"
    r"|[0-9]{3}(?P<phone_sep>[.-])[0-9]{3}(?P=phone_sep)[0-9]{4})(?!-?[A-Za-z0-9]))"
    r"|(?P<card>(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
    r"(?![A-Za-z0-9]))")
#: Rows without this need no scan (checked before texts go to Python).
HINT = "[0-9@]"


#: Characters of an IBAN by country (the SWIFT registry).
IBAN_LENGTH = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}.items() for c in codes.split()}
#: Digits behind the country code: least and most.
PHONE_DIGITS = {c: n for n, codes in {
    (8, 8): "45 47 65 216 386", (9, 9): "27 31 33 34 40 41 48 56 61 212 351 380 420 421",
    (10, 10): "1 7 30 52 57 63 90 91 92", (8, 9): "32 36 51 66 213 385 971 972", (9, 10): "44 81 84",
    (10, 11): "54 55 86", (8, 10): "20 64 82", (7, 9): "46 353", (7, 11): "49", (8, 11): "39",
    (6, 10): "358", (8, 12): "62"}.items() for c in codes.split()}
_TWO_DIGIT_CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 "
                       "66 81 82 84 86 90 91 92 93 94 95 98".split())


def feistel(value: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """A keyed permutation of 0..size-1; ``tweak`` (the format) selects it.

    The value is split into two halves with moduli a * b >= size; rounds add
    a keyed hash of one half to the other.  Results beyond ``size`` are
    permuted again (cycle walking), which keeps it a bijection.
    """
    if size < 2:
        return value
    a = int(size ** 0.5)
    while a * a < size:
        a += 1
    b = -(-size // a)
    tag = f"{tweak}|{size}|".encode()

    def f(n: int, half: int) -> int:
        h = hashlib.blake2b(tag + b"%d|%d" % (n, half), key=key[:64], digest_size=16)
        return int.from_bytes(h.digest(), "big")

    while True:
        left, right = divmod(value, b)
        steps = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
        for n in steps:
            sign = -1 if inverse else 1
            if n % 2 == 0:
                left = (left + sign * f(n, right)) % a
            else:
                right = (right + sign * f(n, left)) % b
        value = left * b + right
        if value < size:
            return value


Permute = Callable[[int, int, str], int]


def _radix(digits: list[tuple[int, int]], tweak: str, permute: Permute) -> list[int]:
    """Permutes a mixed-radix number given as (digit, base) pairs."""
    value, size = 0, 1
    for d, base in digits:
        value, size = value * base + d, size * base
    value = permute(value, size, tweak)
    out = []
    for _, base in reversed(digits):
        value, d = divmod(value, base)
        out.append(d)
    return out[::-1]


def _classes(chars: str, tweak: str, permute: Permute) -> str:
    """Permutes ASCII digits and letters within their class; the rest stays."""
    low = {**dict.fromkeys("0123456789", ("0", 10)), **{chr(c): ("a", 26) for c in range(97, 123)},
           **{chr(c): ("A", 26) for c in range(65, 91)}}
    kind = [low.get(c) for c in chars]
    got = iter(_radix([(ord(c) - ord(k[0]), k[1]) for c, k in zip(chars, kind) if k], tweak, permute))
    return "".join(chr(ord(k[0]) + next(got)) if k else c for c, k in zip(chars, kind))


def _fill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` + digit valid."""
    total = sum(sum(divmod(int(c) * (2 if i % 2 == 0 else 1), 10)) for i, c in enumerate(reversed(body)))
    return str(-total % 10)


def _card(s: str, permute: Permute) -> str | None:
    d = re.sub(r"[ -]", "", s)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    lead = 1 if d[0] != "0" else 0  # a leading zero stays, others stay non-zero
    first = [(int(d[0]) - 1, 9)] if lead else [(0, 1)]
    body = _radix(first + [(int(c), 10) for c in d[1:-1]], f"card{len(d)}{lead}", permute)
    body = str(body[0] + lead) + "".join(map(str, body[1:]))
    return _fill(s, body + luhn_digit(body))


def _phone_head(s: str) -> str:
    """``+`` and the country code, or nothing."""
    if s[0] != "+":
        return ""
    run = re.match("[0-9]+", s[1:]).group()
    return "+" + run[:1 if run[0] in "17" else 2 if run[:2] in _TWO_DIGIT_CODES else 3]


def _phone_end(s: str) -> int:
    """Where a number with a country code ends, by its code and the lengths of
    its groups alone, so a pseudonym ends there too.  Of the group ends with
    as many digits as the country has, it is the first behind a group of six
    digits or more, or else the last; without such an end, the last that
    leaves at most 15 digits.  One digit in brackets, ``(0)``, doesn't count."""
    head = _phone_head(s)
    low, high = PHONE_DIGITS.get(head[1:], (15, 0))
    n, fit, other = 0, [], [0]
    for g in re.finditer("[0-9]+", s[len(head):]):
        end = len(head) + g.end()
        if s[end:end + 1] == ")":
            n += len(g.group()) if len(g.group()) > 1 else 0
            continue
        n += len(g.group())
        if re.match("-[0-9]", s[end:]):  # goes on
            continue
        if low <= n <= high:
            fit.append((len(g.group()) < 6, -end))
        if len(re.sub("[^0-9]", "", s[:end])) <= 15:
            other.append(end)
    return -min((f for f in fit if not f[0]), key=lambda f: -f[1], default=min(fit, default=(0, -other[-1])))[1]


def _phone(s: str, permute: Permute) -> str | None:
    head = _phone_head(s)
    d = re.sub(r"[^0-9]", "", s[len(head):])
    if not 7 <= len(d) + len(head.lstrip("+")) <= 15:
        return None
    return head + _fill(s[len(head):], "".join(map(str, _radix(
        [(int(c), 10) for c in d], f"phone{head}/{len(d)}", permute))))


def _ipv4(s: str, permute: Permute) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    low = [(0, 10, 100)[len(p) - 1] for p in parts]
    size = [(10, 90, 156)[len(p) - 1] for p in parts]
    got = _radix([(int(p) - a, n) for p, a, n in zip(parts, low, size)],
                 "ip" + "".join(str(len(p)) for p in parts), permute)
    return ".".join(str(a + v) for a, v in zip(low, got))


def _iban_ok(s: str) -> bool:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _iban_end(s: str) -> int:
    """The first end of a valid IBAN, at a space or at the end of ``s``; 0
    without one.  Ends before the country's length are left out if ``s``
    reaches that length."""
    ends = [m.start() for m in re.finditer(" |$", s)]
    size = {e: e - s.count(" ", 0, e) for e in ends}
    least = IBAN_LENGTH.get(s[:2], 15)
    least = least if size[ends[-1]] >= least else 15
    return next((e for e in ends if least <= size[e] <= 34 and _iban_ok(s[:e].replace(" ", ""))), 0)


def _iban(s: str, permute: Permute) -> str | None:
    if _iban_end(s) != len(s):
        return None
    d = s.replace(" ", "")
    tweak = "iban" + d[:2] + re.sub("[A-Z]", "A", re.sub("[0-9]", "0", d[4:]))
    body = d[4:]
    while True:  # walk on to the next one that doesn't end earlier
        body = _classes(body, tweak, permute)
        check = 98 - int("".join(str(int(c, 36)) for c in body + d[:2] + "00")) % 97
        it = iter(f"{d[:2]}{check:02d}{body}")
        new = "".join(c if c == " " else next(it) for c in s)
        if _iban_end(new) == len(new):
            return new


def _ssn(s: str, permute: Permute) -> str | None:
    a, g, n = map(int, s.split("-"))
    if a in (0, 666) or a >= 900 or not g or not n:
        return None
    a, g, n = _radix([(a - 1 - (a > 666), 898), (g - 1, 99), (n - 1, 9999)], "ssn", permute)
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{n + 1:04d}"


_FIRST, _DAYS = dt.date(1900, 1, 1).toordinal(), (dt.date(2100, 1, 1) - dt.date(1900, 1, 1)).days


def _date(s: str, permute: Permute) -> str | None:
    sep = re.search("[^0-9]", s).group()
    p = s.split(sep)
    short = any(len(x) == 1 for x in p)
    if short and any(x[0] == "0" for x in p):
        return None

    def day_of(parts: list[str]) -> tuple[str, int] | None:
        """Field order and day number; day before month where both fit."""
        for order in ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy"):
            part = dict(zip(order, map(int, parts)))
            try:
                day = dt.date(part["y"], part["m"], part["d"]).toordinal() - _FIRST
            except ValueError:
                continue
            if 0 <= day < _DAYS:
                return order, day
        return None

    if (found := day_of(p)) is None:
        return None
    order, day = found
    lengths = [len(x) for x in p]
    while True:  # walk on to the next date that is written the same way
        day = permute(day, _DAYS, f"date{order}{sep}{lengths}")
        new = dt.date.fromordinal(day + _FIRST)
        both = dict(zip("ymd", (new.year, new.month, new.day)))
        q = [str(both[o]) if short or o == "y" else f"{both[o]:02d}" for o in order]
        if [len(x) for x in q] == lengths and day_of(q) == (order, day):
            return sep.join(q)


def _email(s: str, permute: Permute) -> str | None:
    local, domain = s.rsplit("@", 1)
    shape = re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", local)))
    return _classes(local, f"email{shape}@{domain.lower()}", permute) + "@" + domain


_BY_KIND = dict(zip(KINDS, (_email, _iban, _ipv4, _date, _ssn, _phone, _card)))


def pseudonym(kind: str, value: str, key: bytes, inverse: bool = False) -> str | None:
    """The value's pseudonym (or, with ``inverse``, the value of a pseudonym),
    or null if it is not a valid value of its kind."""
    return _BY_KIND[kind](value, lambda v, n, tweak: feistel(v, n, key, tweak, inverse))


def _end(kind: str, s: str) -> int:
    """How much of a match is the value: groups behind it may be other words
    or numbers."""
    if kind == "iban":
        return _iban_end(s)
    return _phone_end(s) if kind == "phone" and s[0] == "+" else len(s)


def replace_all(text: str, key: bytes, inverse: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every valid value replaced, and the count of each kind.
    A match that is not valid is left, and the search goes on behind its
    first character, so a value inside it is still found; behind a value it
    goes on at the value's end, not at the match's."""
    out, counts, at, copied = [], {}, 0, 0
    while m := PATTERN.search(text, at):
        value = m.group()[:_end(m.lastgroup, m.group())]
        new = pseudonym(m.lastgroup, value, key, inverse) if value else None
        if new is None:
            at = m.start() + 1
            continue
        out += [text[copied:m.start()], new]
        counts[m.lastgroup] = counts.get(m.lastgroup, 0) + 1
        at = copied = m.start() + len(value)
    return "".join(out) + text[copied:], counts


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", counts: str | None = None,
                 inverse: bool = False) -> DataFrame:
    """``docs`` with valid emails, IBANs, IPv4 addresses, dates, social
    security numbers, phone and card numbers in ``text`` replaced; with
    ``counts``, a map column of that name says how many of each kind.

    The key is the deployment's secret (1 to 64 bytes).  Very long texts are
    searched whole.  Null texts stay
    null, empty ones empty, and texts without digits and ``@`` are not sent
    to Python.  Lengths stay the same.  Rows, order and all other columns
    (repeated rows, null ids, any names) stay as they are.
    """
    schema = T.StructType([T.StructField("t", T.StringType()),
                           T.StructField("c", T.MapType(T.StringType(), T.IntegerType()))])

    @F.pandas_udf(schema)
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [replace_all(t, key, inverse) if t is not None else (None, {}) for t in batch]
            yield pd.DataFrame({"t": [g[0] for g in got], "c": [g[1] for g in got]})

    tmp = "_pii" + "_" * max(map(len, docs.columns), default=0)
    d = docs.withColumn(tmp, replaced(F.when(F.col(text).rlike(HINT), F.col(text))))
    d = d.withColumn(text, F.coalesce(F.col(tmp)["t"], F.col(text)))
    if counts:
        d = d.withColumn(counts, F.coalesce(F.col(tmp)["c"], F.create_map().cast("map<string,int>")))
    return d.drop(tmp)
