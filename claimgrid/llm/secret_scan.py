"""Secret scans: fixed patterns, and a guess-cost dynamic programme for values in credential contexts.

The cost of a value is the least log10 of guesses over all ways to cut it into known words (by rank), dates, repeats of blocks of
up to four characters, keyboard walks and brute-force spans: costs of pieces add up. A value that follows a credential word and costs at least ``MIN_COST`` is a
secret. Base kinds: ``assign``, ``access`` and ``hex``; the programme adds kind ``guess`` for values in wider contexts
(other credential words, or "is" or a blank instead of a sign) that no base span wholly covers. A context within a value that isn't
a secret counts too. Without a ":" or "=", letters in the case of a word (all small, all capital, or capitalised) are read as
prose unless they cost PROSE_COST. A value ends at white space, quotes or separators, without closing points and brackets.

Offsets are code points, ends exclusive. Defined cases: a null or empty text has no spans; matches of a kind don't overlap, the
leftmost comes first; repeated rows have equal results; a null doc_id is a row like others; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order of the kinds.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of these letters that is long enough, as no match can begin within a run
KINDS = ("assign", "access", "hex", "guess")
# Wider credential contexts, up to where the value begins; the word may have letters, digits or "_" before it.
CONTEXT = re.compile(r"""(?ai:(pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth|bearer|(?:api|access|private|secret|client)[_-]?(?:key|secret|token)))["']?(?:\s{0,3}([:=])\s{0,3}|\s+(?i:is|was)\s+|\s+)["']?(?=[^\s"'<>|,;]{6})""")
VALUE = re.compile(r"""[^\s"'<>|,;]+""")
_CONTEXT_WORDS = ("pass", "pwd", "pin", "secret", "token", "credential", "auth", "bearer", "key")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Most ranked words that are broadcast.
MAX_WORDS = 1_000_000
#: Least cost of a secret (above eight signs of all classes it is some 10.5), and of letters alone without a sign, in the case of
#: a word (11 letters at random).
MIN_COST, PROSE_COST = 10.0, 15.5
# Frequent words of passwords, in order of rank. A longer ranked list can follow (``ranked``).
WORDS = """password love iloveyou monkey dragon master hello freedom whatever trust shadow sunshine princess welcome login admin
letmein football baseball superman batman starwars michael jordan jennifer hunter soccer killer pepper ginger summer winter spring
autumn flower cookie cheese orange purple silver golden secret access system server change default guest test user root pass word
token account number house water light night morning happy music magic money the and for you with this that have from your
please required invalid missing reset forgot enter your new old here below above example sample string value none null true false""".split()
#: Most characters of a word, and of a repeat or walk that stops before its run does.
LONGEST_WORD, LONGEST_PIECE = 24, 32
# The rows of a keyboard from the top, each a little further right than the one above; and the alphabet.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
_YEAR, _MONTH, _DAY, _GAP = r"(?:19|20)\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])", r"[-/._]?"
#: A year, year month day, and day month year with or without leading zeros: each has one end for a start.
DATES = [re.compile(x) for x in (_YEAR, _YEAR + _GAP + _MONTH + _GAP + _DAY, *(d + _GAP + m + _GAP + _YEAR for d in (_DAY, "[1-9]") for m in (_MONTH, "[1-9]")))]
# Signs that stand for letters.
LEET = str.maketrans("@431!05$7", "aaeiiosst")


def _neighbours() -> dict[tuple[str, str], int]:
    """Direction of a step from a key to a key beside it in two dimensions, or along the alphabet."""
    steps = {}
    place = {c: (r, i) for r, row in enumerate(KEYBOARD) for i, c in enumerate(row)}
    for a, (r, i) in place.items():
        for b, (q, j) in place.items():
            if (q - r, j - i) in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)):
                steps[a, b] = (q - r) * 3 + j - i
    for a, b in zip(ALPHABET, ALPHABET[1:], strict=False):
        steps.setdefault((a, b), 10)
        steps.setdefault((b, a), 11)
    return steps


STEPS = _neighbours()


def ranked(words: Iterable[str]) -> dict[str, int]:
    """Rank from 1 of words by their order, after those of WORDS; lower-cased, 3 to LONGEST_WORD characters."""
    out: dict[str, int] = {}
    for w in (*WORDS, *words):
        if 3 <= len(w) <= LONGEST_WORD:
            out.setdefault(w.lower(), len(out) + 1)
    return out


def ranked_of_vocabulary(path: str, end: str = "</w>") -> dict[str, int]:
    """The whole words of a tokenizer's vocabulary file: ids follow the frequency of its merges, so they rank words."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    whole = [t.removesuffix(end) for t in sorted(vocab, key=vocab.get) if t.endswith(end)]
    return ranked(w for w in whole if w.isascii() and w.isalpha())


RANKS = ranked(())


# log10 of how many digits, letters of a case and other signs there are.
DIGIT, LETTER, SIGN = 1.0, math.log10(26), math.log10(33)


def brute(ch: str) -> float:
    """log10 of the guesses for one character of a brute-force span: of its class, and of letters beyond A-Z more."""
    if ch.isdigit():
        return DIGIT
    return LETTER if ch.isascii() and ch.isalpha() else SIGN


def word_cost(piece: str, rank: int, swapped: bool) -> float:
    """A word's rank, where its capitals are, and whether signs stand for letters."""
    upper = sum(c.isupper() for c in piece)
    case = 0.0 if not upper else 0.3 if upper in (1, len(piece)) else 0.3 * min(upper, len(piece) - upper) + 0.3
    return 0.3 + math.log10(rank + 1) + case + (0.5 if swapped else 0.0)


def date_cost(piece: str) -> float:
    return math.log10(120) if len(piece) == 4 else math.log10(120 * 365) + 0.3


def repeat_cost(block: str, times: int) -> float:
    return sum(map(brute, block)) + math.log10(times) + 0.3


def walk_cost(n: int, turns: int) -> float:
    """The first key, the length, and the way at each turn."""
    return 1.6 + math.log10(n) + 0.7 * turns


def pieces(value: str, ranks: dict[str, int] = RANKS) -> Iterator[tuple[int, int, float]]:
    """(start, end, cost) of all pieces that a segmentation may use, by start. Those from one start are bounded in number:
    repeats and walks end after at most LONGEST_PIECE characters or with their run; dates at each of their layouts' ends."""
    n, low = len(value), value.lower()
    if len(low) != n:  # a letter whose small form has two characters
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in value)
    plain = low.translate(LEET)
    runs = [[0] * (n + 1) for _ in range(5)]  # how far characters are equal to those k places on
    walk, bends = [1] * (n + 1), [0] * (n + 1)  # how far a walk goes on, and its turns on that way
    for i in range(n - 1, -1, -1):
        for k in range(1, 5):
            runs[k][i] = runs[k][i + 1] + 1 if i + k < n and value[i] == value[i + k] else 0
        if i + 1 < n and (way := STEPS.get((low[i], low[i + 1]))) is not None:
            walk[i] = walk[i + 1] + 1
            bends[i] = bends[i + 1] + (walk[i + 1] > 1 and STEPS[low[i + 1], low[i + 2]] != way)
    for i in range(n):
        yield i, i + 1, brute(value[i])
        for k in range(3, min(LONGEST_WORD, n - i) + 1):
            for text, swapped in ((low[i : i + k], False), (plain[i : i + k], True)):
                if text in ranks:
                    yield i, i + k, word_cost(value[i : i + k], ranks[text], swapped)
        if "0" <= value[i] <= "9":
            for layout in DATES:
                if m := layout.match(value, i):
                    yield i, m.end(), date_cost(m[0])
        for k in range(1, 5):
            most, least = runs[k][i] // k + 1, 3 if k == 1 else 2
            for times in {*range(least, min(most, LONGEST_PIECE // k) + 1), most}:
                if times >= least:
                    yield i, i + k * times, repeat_cost(value[i : i + k], times)
        turns, way = 0, None
        for m in range(2, min(walk[i], LONGEST_PIECE) + 1):
            step = STEPS[low[i + m - 2], low[i + m - 1]]
            turns, way = turns + (way is not None and step != way), step
            if m >= 3:
                yield i, i + m, walk_cost(m, turns)
        if walk[i] > LONGEST_PIECE:
            yield i, i + walk[i], walk_cost(walk[i], bends[i])


def guess_cost(value: str, ranks: dict[str, int] = RANKS) -> float:
    """The least log10 of guesses over all segmentations; time is linear in the length of value."""
    best = [0.0] + [math.inf] * len(value)
    for i, end, more in pieces(value, ranks):
        if best[i] + more < best[end]:
            best[end] = best[i] + more
    return best[-1]


def _least(text: str, m: re.Match, end: int) -> float:
    """The cost from which a value is a secret. Without a sign, "compass", "spin" and the like are no credential words, and
    letters in the case of a word must cost more."""
    if m[2]:
        return MIN_COST
    value = text[m.end() : end]
    if m.start() > 0 and text[m.start() - 1].isalpha() and m[1].lower() in ("pass", "pin", "auth", "bearer"):
        return math.inf
    return PROSE_COST if value.isalpha() and (value[1:].islower() or value.isupper() or value == value.swapcase()) else MIN_COST


def spans(text: str | None, ranks: dict[str, int] = RANKS) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end) of all spans, in order."""
    if not text:
        return []
    found, low = [], text.lower()
    if any(w in low for w in _ASSIGN_WORDS) or "İ" in text:
        found += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    if any(w in low for w in _CONTEXT_WORDS):
        base = sorted((s, e) for s, _, _, e in found)
        furthest = [0, *accumulate((e for _, e in base), max)]  # end of the base spans that begin up to a place
        stop = done = 0
        for m in CONTEXT.finditer(text):
            s = m.end()
            if s >= stop:
                stop = VALUE.match(text, s).end()
                end = stop - (len(tail := text[s:stop]) - len(tail.rstrip(".:)]}")))
            if s < done or end - s < 6 or end <= furthest[bisect_right(base, (s, math.inf))]:
                continue
            least = _least(text, m, end)
            if least < math.inf and guess_cost(text[s:end], ranks) >= least:
                found.append((s, 3, "guess", end))
                done = end
    return sorted(found)


def joined(found: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in found)


def _shared(docs: DataFrame, words: dict[str, int] | None):
    """A function that gives the ranks in a task."""
    if words is None:
        return lambda: RANKS
    if len(words) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} ranked words")
    shared = docs.sparkSession.sparkContext.broadcast(words)
    return lambda: shared.value


def scanned(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), words: dict[str, int] | None = None) -> DataFrame:
    """keep columns and ``found``, an array of (kind, start, end), one row for each row of docs.

    words: ranks of known words, MAX_WORDS at most, which are broadcast (default: those of WORDS).
    """
    n, ranks = len(keep), _shared(docs, words)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks()
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e} for s, _, k, e in spans(x.as_py(), own)] for x in b.column(n)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(rows, kind)], names=[*keep, "found"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", found array<struct<kind: string, start: long, `end`: long>>"
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def digests(docs: DataFrame, words: dict[str, int] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess of every row of docs."""
    show = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = show(F.filter("found", lambda x: x["kind"] != "guess"))
    return scanned(docs, words=words).select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(base, 256).alias("base_sha256"), show(F.col("found")).alias("spans"), n("guess"))


def redacted(text: str | None, ranks: dict[str, int] = RANKS, mask: str = "*") -> str | None:
    """The text with as many mask characters for every span; spans may overlap."""
    if text is None:
        return None
    out, at = [], 0
    for s, _, _, e in spans(text, ranks):
        if e > at:
            out += [text[at : max(s, at)], mask * (e - max(s, at))]
            at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mask: str = "*", words: dict[str, int] | None = None) -> DataFrame:
    """docs with every span of ``text`` replaced by as many mask characters; a null text stays null."""
    ranks = _shared(docs, words)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ranks()
        for part in texts:
            yield pd.Series([redacted(t, own, mask) for t in part], dtype=object)

    return docs.withColumn("text", F.pandas_udf(run, "string")(F.col("text")))


def base_digest(text: str | None) -> str:
    return hashlib.sha256(joined([x for x in spans(text) if x[2] != "guess"]).encode()).hexdigest()
