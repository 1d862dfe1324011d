"""PII: format-preserving Feistel pseudonyms, so that equal values stay linked across documents.

Validated values are replaced within their format by a keyed permutation of all values of that format: payment cards (Luhn), IBANs
(mod 97), social security numbers, calendar dates, IPv4 addresses, phone numbers and e-mail addresses. A value is ranked as
a number below the format's size, a Feistel network permutes the numbers (cycle walking keeps them in range), and the
result is written in the same layout with its check digits made anew. The permutation depends on the key and the format
alone: no table of values is kept, nothing is shuffled, and whoever holds the key can go back (``restore``). There is no
key in the code: the caller names one, from the session's setting KEY_SETTING or from elsewhere.

A day keeps its pseudonym in every layout, and so do e-mail addresses that differ in the case of letters. For that, days
up to the 12th, which some layouts can't tell from months, are permuted among themselves, and addresses in small letters.

Defined cases: dates of the years 1900 to 2099 stay in these years, others become others; a null text stays null, an empty
one empty; values that fail their check stay as they are; cards and IBANs end where a group of their run ends, an IBAN at its country's length, others at the longest valid end; of overlapping values
the leftmost counts; repeated rows have equal results; a null doc_id is a row like others; an empty table gives an empty
result; other columns of docs are kept.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark hides the values of settings with such a name.
KEY_SETTING, ROUNDS = "spark.claimgrid.pii.secret", 8
DAYS = range(datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal())
EVERY_DAY = range(1, datetime.date.max.toordinal() + 1)
KINDS = ("email", "iban", "card", "ssn", "date", "ip", "phone")
# The layouts that are looked for, in order of precedence.
_LAYOUTS = (
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})",
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9]))",
    r"(?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})(?![\w/-]|\.\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))",
    r"(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w))",
    r"(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w))",
    r"(?P<phone2>(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))",
)
PATTERN = re.compile("|".join(_LAYOUTS))
_MAYBE = re.compile(r"@|\d")
# The layouts whose values may follow in the run of a card or an IBAN.
_OTHER = re.compile("|".join(x for x in _LAYOUTS if not x.startswith(("(?P<iban>", "(?P<card>"))))
# The length of an IBAN in each country of the registry.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29
ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24
ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26
UA29 VA22 VG24 XK20 YE30""".split()}


class Permuter:
    """Keyed permutations of 0..n-1, one for each (tweak, n)."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).digest()

    def __call__(self, value: int, n: int, tweak: str, back: bool = False) -> int:
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        mask, size, name = (1 << half) - 1, (half + 7) // 8, f"{tweak}:{n}:".encode()
        while True:
            left, right = value >> half, value & mask
            for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
                x = left if back else right
                f = int.from_bytes(hashlib.blake2b(name + bytes([r]) + x.to_bytes(size, "big"), key=self.key, digest_size=min(64, size + 1)).digest(), "big") & mask
                left, right = (right ^ f, left) if back else (right, left ^ f)
            value = left << half | right
            if value < n:
                return value


def luhn(digits: str) -> int:
    """The check digit that makes digits + itself valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def refill(layout: str, chars: str) -> str:
    """layout with its letters and digits replaced in turn."""
    own = iter(chars)
    return "".join(next(own) if c.isalnum() else c for c in layout)


def permuted_text(text: str, tweak: str, f: Permuter, back: bool) -> str:
    """Lower-case letters, capitals and digits stay of their kind; the rest stays."""
    value, n, sizes = 0, 1, []
    for c in text:
        for low, size in (("a", 26), ("A", 26), ("0", 10)):
            if low <= c < chr(ord(low) + size):
                value, n = value * size + ord(c) - ord(low), n * size
                sizes.append((low, size))
                break
        else:
            sizes.append((c, 1))
    value = f(value, n, tweak + ":" + "".join(c for c, _ in sizes), back)
    out = []
    for low, size in reversed(sizes):
        value, r = divmod(value, size)
        out.append(chr(ord(low) + r))
    return "".join(reversed(out))


def email(s: str, f: Permuter, back: bool) -> str | None:
    """Capitals are where they were, and of no effect on the rest."""
    name, _, top = s.rpartition(".")
    new = permuted_text(name.lower(), "email", f, back)
    return "".join(c.upper() if old.isupper() else c for c, old in zip(new, name, strict=True)) + "." + top


def card(s: str, f: Permuter, back: bool) -> str | None:
    digits = "".join(c for c in s if c.isdigit())
    body = digits[:-1]
    if luhn(body) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    new = str(f(int(body), 10 ** len(body), f"card{len(digits)}", back)).zfill(len(body))
    return refill(s, new + str(luhn(new)))


def iban(s: str, f: Permuter, back: bool) -> str | None:
    plain = s.replace(" ", "")
    number = lambda t: int("".join(str(int(c, 36)) for c in t))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = permuted_text(plain[4:], "iban" + plain[:2], f, back)
    check = 98 - number(body + plain[:2] + "00") % 97
    return refill(s, plain[:2] + f"{check:02d}" + body)


def ssn_valid(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(s: str, f: Permuter, back: bool) -> str | None:
    n = int(s.replace("-", ""))
    if not ssn_valid(n):
        return None
    n = f(n, 10**9, "ssn", back)
    while not ssn_valid(n):  # walks on to the next valid number of the cycle
        n = f(n, 10**9, "ssn", back)
    return refill(s, f"{n:09d}")


def moved_day(day: datetime.date, f: Permuter, back: bool) -> datetime.date:
    """Another day that is like the first within 1900 to 2099 or not, and within the first twelve days of a month or not."""
    near = day.toordinal() in DAYS
    every, kind = (DAYS, "date") if near else (EVERY_DAY, "far date")
    value = day.toordinal() - every[0]
    while True:
        value = f(value, len(every), kind, back)
        new = datetime.date.fromordinal(every[0] + value)
        if (new.day > 12) == (day.day > 12) and (near or new.toordinal() not in DAYS):
            return new


def date(s: str, f: Permuter, back: bool) -> str | None:
    """Months come first where both readings are days, but with points days do."""
    a, b, c = (int(x) for x in re.split(r"[-/.]", s))
    readings = [(a, b, c, "ymd")] if s[4:5] in ("-", "/") else [(c, b, a, "dmy")] if "." in s else [(c, a, b, "mdy"), (c, b, a, "dmy")]
    for year, month, day, order in readings:
        try:
            new = moved_day(datetime.date(year, month, day), f, back)
        except ValueError:
            continue
        parts = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return refill(s, "".join(parts[x] for x in order))
    return None


def ip(s: str, f: Permuter, back: bool) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or (p != "0" and p[0] == "0") for p in parts):
        return None
    n = f(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip", back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def phone(s: str, f: Permuter, back: bool) -> str | None:
    digits = "".join(c for c in s if c.isdigit())
    code = re.match(r"\+(\d{1,3}?)(?=[ .-]|\()", s)
    keep = code[1] if code else digits[:1] if s[0] == "+" else ""
    body = digits[len(keep) :]
    if not 7 <= len(body) <= 14:
        return None
    return refill(s, keep + str(f(int(body), 10 ** len(body), f"phone{keep}", back)).zfill(len(body)))


CHANGE: dict[str, Callable[[str, Permuter, bool], str | None]] = {"email": email, "iban": iban, "card": card, "ssn": ssn, "date": date, "ip": ip, "phone": phone, "phone2": phone}


def _ends(text: str, m: re.Match) -> list[int]:
    """Where the value that begins with m may end, the likeliest first: ends of groups in the run of a card or an IBAN."""
    if m.lastgroup not in ("card", "iban"):
        return [m.end()]
    starts = [i + 1 for i in range(m.start(), m.end()) if text[i] in " -"]
    stop = next((i for i in starts if _OTHER.match(text, i)), m.end() + 1)
    counts = {i: sum(map(str.isalnum, text[m.start() : i])) for i in (*(i - 1 for i in starts), m.end()) if i < stop}
    least, most = (13, 19) if m.lastgroup == "card" else (15, 34)
    ends = sorted((i for i, n in counts.items() if least <= n <= most), reverse=True)
    length = IBAN_LENGTHS.get(m[0][:2]) if m.lastgroup == "iban" else None
    if length is None:
        return ends
    return [i for i in ends if counts[i] == length] or ends[:1]


def _first(text: str, pos: int, f: Permuter, back: bool) -> tuple[int, int, str, str, int | None] | None:
    """start, end, kind, pseudonym of the first value from pos on, and where a failed reading begins that overlaps it (or None)."""
    failed: list[tuple[int, int]] = []
    while m := PATTERN.search(text, pos):
        for end in _ends(text, m):
            new = CHANGE[m.lastgroup](text[m.start() : end], f, back)
            if new is not None:
                return m.start(), end, m.lastgroup, new, min((a for a, b in failed if b > m.start()), default=None)
            failed.append((m.start(), end))
        pos = m.start() + 1
        while pos < m.end() and text[pos].isalnum() and text[pos - 1].isalnum():
            pos += 1  # a rejected run of digits isn't looked at from its middle
        failed = [x for x in failed if x[1] > pos]
    return None


def pseudonyms(text: str | None, f: Permuter, back: bool = False) -> tuple[str | None, list[str]]:
    """The text with pseudonyms, and the kinds of the values replaced, in order."""
    if not text or not _MAYBE.search(text):
        return text, []
    out, at, kinds = [], 0, []
    while found := _first(text, at, f, back):
        start, end, kind, new, failed = found
        if failed is not None:  # walks on to a value beside which the failed readings fail too, or the way back would be lost
            low = max(failed - 2, 0)
            while (again := _first(text[low:start] + new + text[end : end + 100], failed - low, f, back)) is None or again[:2] != (start - low, end - low):
                new = CHANGE[kind](new, f, back)
        out += [text[at:start], new]
        kinds.append(kind.rstrip("2"))
        at = end
    return "".join(out) + text[at:], kinds


def session_key(spark: SparkSession) -> str:
    """The key of KEY_SETTING. Without one, a random key is made for this session: values are linked within it, and there is
    no way back once it ends."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """docs with pseudonyms in ``text``, and ``n_<kind>`` for each kind and ``n_values``; other columns as they are.

    A column of docs that already has such a name is replaced.
    """
    added = [f"n_{k}" for k in KINDS] + ["n_values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Permuter(key)
        for b in batches:
            texts, found = [], []
            for t in b.column(0):
                text, kinds = pseudonyms(t.as_py(), f, back)
                texts.append(text)
                found.append(kinds)
            counts = [pa.array([x.count(k) for x in found], pa.int32()) for k in KINDS] + [pa.array([len(x) for x in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *counts, *b.columns[1:]], names=["text", *added, *rest])

    rest = [c for c in docs.columns if c != "text" and c not in added]
    fields = [f"{c} int" for c in added] + [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest]
    out = docs.select("text", *(F.col(f"`{c}`") for c in rest)).mapInArrow(run, "text string, " + ", ".join(fields))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added), *added)


def restore(docs: DataFrame, key: str) -> DataFrame:
    return pseudonymise(docs, key, back=True)
