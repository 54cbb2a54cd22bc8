"""Secret scan: three fixed patterns and a randomness test battery.

The battery takes every run of 20 or more key-like characters, infers the
encoding (the smallest alphabet among hex, base32, base62, base64 that holds
it; 26 or 52 letters for letters alone) and tests the symbols for what a random key shows: chi-squared uniformity
over the alphabet, the runs test about the alphabet's middle, and lag-one
serial correlation, combined by Fisher's method. A token on which the battery
rejects randomness is dropped; if it has separators (``/ + - _``), its pieces
of 20 or more characters are tested instead, as keys stand behind paths and names.

The others are tested against ordinary text of the same length (letter
repeats, for letters alone their rarity, and changes between lower case, upper
case and digits), which gives a p-value that falls with the length of a random
token. The Benjamini-Hochberg procedure controls the share of false discoveries
over the whole corpus, separately for each class of lengths, since short tokens
tell less, and for letters alone, which ordinary text is full of.

Defined results: null text counts as empty; an empty table gives an empty
result; every row gives one row, repeated rows and ids included, and null ids
stay null; texts are read whole, however long, in time linear in them; spans
are code points, end exclusive, sorted by start, then kind, and of equal starts
and kinds by end. Base spans are never dropped by the battery. Only id and text
are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import map_texts, ship, written

ship(__name__)

# The base patterns and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as [0-9a-f]+ finds them

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
ALPHABETS = (
    ("hex", _DIGITS + "abcdef"), ("hex", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"),
    ("base62", _UPPER + _LOWER + _DIGITS), ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Keys of letters alone; no digit says that they are no words.
LETTERS = (("letters", _LOWER), ("letters", _UPPER), ("letters", _UPPER + _LOWER))
SEPARATORS = re.compile("[/+_-]+")
LEAST = 20
_SETS = tuple((frozenset(a), {c: i for i, c in enumerate(a)}) for _, a in ALPHABETS)
_LETTER_SETS = tuple((frozenset(a), {c: i for i, c in enumerate(a)}) for _, a in LETTERS)

#: Share of ordinary text: English letter frequencies in per mille, digits as one letter in 20.
LETTER_SHARE = dict(zip("etaoinshrdlcumwfgypbvkjxqz",
                        (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20,
                         19, 15, 10, 8, 2, 2, 1, 1)))
SWITCH = 0.15  # chance that two neighbours in ordinary text differ in class
BATTERY_ALPHA = 0.001
FALSE_DISCOVERY = 0.01
LENGTH_CLASSES = (20, 28, 40, 64, 128)
FAMILIES = 2 * len(LENGTH_CLASSES)
BINS_A_DECADE, TOP_BIN = 4, 160


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _fisher(*p: float) -> float:
    """Combined p-value: chi-squared of -2 sum(ln p) with 2 len(p) degrees of freedom."""
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    term = total = 1.0
    for i in range(1, len(p)):
        term *= half / i
        total += term
    return min(1.0, math.exp(-half) * total)


def randomness(x: list[int], size: int) -> float:
    """Combined p-value of uniformity, runs and serial correlation of symbols below ``size``."""
    n = len(x)
    chi = size / n * sum(c * c for c in Counter(x).values()) - n
    free = size - 1
    wilson = ((max(chi, 0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    uniform = _normal_tail(wilson)
    high = [2 * v >= size for v in x]
    ups = sum(high)
    if ups in (0, n):
        runs = 0.5 ** (n - 1)
    else:
        mean = 2 * ups * (n - ups) / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        count = 1 + sum(a != b for a, b in zip(high, high[1:]))
        runs = 2 * _normal_tail(abs(count - mean) / spread)
    middle = sum(x) / n
    power = sum((v - middle) ** 2 for v in x)
    serial = 0.0
    if power:
        r = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:])) / power
        serial = 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))
    return _fisher(uniform, runs, serial)


def _ordinary(alphabet: str) -> tuple[float, float]:
    """Sums of squares and cubes of the shares that ordinary text gives the alphabet."""
    share = [LETTER_SHARE.get(c, LETTER_SHARE.get(c.lower(), 0) * 0.1 if c.isupper() else 5.0)
             for c in alphabet]
    total = sum(share)
    return sum((s / total) ** 2 for s in share), sum((s / total) ** 3 for s in share)


_MOMENTS = tuple(_ordinary(a) for _, a in ALPHABETS)


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2


def ordinary(token: str, moments: tuple[float, float]) -> float:
    """P-value of ``token`` as a piece of ordinary text: few repeats, many changes of class."""
    n, (s2, s3) = len(token), moments
    pairs = sum(c * (c - 1) // 2 for c in Counter(token).values())
    mean = n * (n - 1) / 2 * s2
    var = n * (n - 1) / 2 * (s2 - s2 * s2) + n * (n - 1) * (n - 2) * max(s3 - s2 * s2, 0)
    repeats = 1 - _normal_tail((pairs + 0.5 - mean) / math.sqrt(max(var, 1e-9)))
    return _fisher(max(repeats, 1e-12), _switches(token))


_LOG_SHARE = {c: math.log(v / sum(LETTER_SHARE.values())) for c, v in LETTER_SHARE.items()}
_LOG_MEAN = sum(math.exp(v) * v for v in _LOG_SHARE.values())
_LOG_VAR = sum(math.exp(v) * (v - _LOG_MEAN) ** 2 for v in _LOG_SHARE.values())


def _switches(token: str) -> float:
    """P-value of the changes of class between neighbours in ordinary text."""
    kinds = [_class(c) for c in token]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    m, tail = len(token) - 1, 0.0
    term = (1 - SWITCH) ** m
    for k in range(m + 1):
        if k >= changes:
            tail += term
        term *= (m - k) / (k + 1) * SWITCH / (1 - SWITCH)
    return max(min(tail, 1.0), 1e-300)


def ordinary_letters(token: str) -> float:
    """P-value of letters as a piece of ordinary text: rare letters, many changes of case."""
    n = len(token)
    logs = sum(_LOG_SHARE[c] for c in token.lower())
    rare = _normal_tail((n * _LOG_MEAN - logs) / math.sqrt(n * _LOG_VAR))
    return _fisher(max(rare, 1e-300), _switches(token))


def judge(token: str) -> float:
    """P-value of a candidate as ordinary text; 1 when it isn't random in an encoding."""
    body = token.rstrip("=")
    if body.isdigit():
        return 1.0  # digits alone: numbers, no encoding is inferred
    symbols = set(body)
    if body.isalpha():
        own, index = next(x for x in _LETTER_SETS if symbols <= x[0])
        if randomness([index[c] for c in body], len(own)) < BATTERY_ALPHA:
            return 1.0
        return ordinary_letters(body)
    if not symbols & set(_DIGITS):
        return 1.0  # words joined by separators; their pieces are judged
    for (own, index), (_, alphabet), moments in zip(_SETS, ALPHABETS, _MOMENTS):
        if symbols <= own:
            if randomness([index[c] for c in body], len(alphabet)) < BATTERY_ALPHA:
                return 1.0
            return ordinary(body, moments)
    return 1.0


def judged(start: int, token: str) -> list[tuple[int, int, float]]:
    """(start, end, p) of a run, or of its long pieces where the run isn't random itself."""
    p = judge(token)
    if p < 1 or not SEPARATORS.search(token):
        return [(start, start + len(token), p)]
    out, at = [], 0
    for m in [*SEPARATORS.finditer(token), None]:
        end = m.start() if m else len(token)
        if len(token[at:end].rstrip("=")) >= LEAST:
            out.append((start + at, start + end, judge(token[at:end])))
        at = m.end() if m else end
    return out or [(start, start + len(token), p)]


def length_class(n: int) -> int:
    return max(i for i, least in enumerate(LENGTH_CLASSES) if n >= least)


def family(token: str) -> int:
    """Tokens whose false discoveries are controlled together: by length, letters alone apart."""
    return length_class(len(token)) + len(LENGTH_CLASSES) * token.isalpha()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= ASSIGN_LEAST:
            out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, family, bin of -log10 p) of the runs outside the base spans."""
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        # both lists go by their starts: reach is how far the spans that start before go
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach > start:
            continue
        for a, b, p in judged(start, m[0]):
            bin_ = min(TOP_BIN, int(-math.log10(max(p, 1e-300)) * BINS_A_DECADE))
            out.append((a, b, family(text[a:b]), bin_))
    return out


def _kernel(texts: list[str]) -> list:
    spans, found = [], []
    for text in texts:
        base = base_spans(text)
        spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
        found.append([{"start": s, "end": e, "size": c, "bin": b}
                      for s, e, c, b in candidates(text, base)])
    return [spans, found]


def discovery_bins(counts: list[tuple[int, int, int]]) -> dict[int, int]:
    """Least bin per family at which Benjamini-Hochberg holds; none: TOP_BIN + 1.

    ``counts``: (family, bin, tokens). A bin stands for its largest p.
    """
    least = {c: TOP_BIN + 1 for c in range(FAMILIES)}
    for c in least:
        own = sorted(((b, n) for k, b, n in counts if k == c), reverse=True)
        total, seen = sum(n for _, n in own), 0
        for b, n in own:
            seen += n
            if 10 ** (-b / BINS_A_DECADE) * total / seen <= FALSE_DISCOVERY:
                least[c] = b
    return least


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base and spans as array<struct<start, kind, end>>.

    ``kind`` indexes KINDS; ``base`` has the spans of the fixed patterns,
    ``spans`` those and the accepted random tokens. What returns to the driver
    is a histogram of at most FAMILIES x (TOP_BIN + 1) counts over
    all candidates of the corpus.
    """
    span = "array<struct<start:int,kind:int,end:int>>"
    one = map_texts(docs, id_col, text_col, _kernel, f"base {span}, found "
                    "array<struct<start:int,end:int,size:int,bin:int>>")
    one = written(one, "secret-candidates")
    counts = one.select(F.explode("found").alias("c")).groupBy("c.size", "c.bin").count()
    least = discovery_bins([tuple(r) for r in counts.collect()])
    floors = F.array(*[F.lit(least[c]) for c in range(FAMILIES)])
    good = F.filter("found", lambda c: c["bin"] >= F.get(floors, c["size"]))
    good = F.transform(good, lambda c: F.struct(
        c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
        c["end"].alias("end")))
    return one.select(F.col("id").alias(id_col), "base",
                      F.array_sort(F.concat("base", good)).alias("spans"))


def span_text(col: str):
    """``kind:start:end`` of the spans in order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
