"""Operator 3: secrets in texts, by patterns and by tests of randomness.

Three patterns give the base spans. Beyond them, runs of token characters are tested: the smallest
encoding that holds a run is inferred, and three tests ask whether its symbols look drawn evenly and
independently from that alphabet: chi-squared uniformity, runs about the middle of the alphabet, and
serial correlation. Fisher's method combines their p-values. Random keys have evenly spread combined
p-values; words, paths and serial numbers have p-values near 0.

A run with path or word separators is tested whole and in the pieces between them, since a key may hold
such characters or stand behind a path. Runs without digits are tested against their alphabet without
digits, which is what such a key is drawn from; there, and where all separators are mixed, three more
tests tell words: share of vowels, changes between vowels and others, and share of capitals.

Where to cut is found from all distinct candidates of the corpus, for each encoding and band of lengths
by itself, since short runs look random more easily. The upper half of the p-values tells how many
random runs there are; the cut is the lowest one at which at most a share ``q`` of what lies above it
exceeds that number.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.runtime import Batches, map_batches, slices

KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
SHORTEST = 20
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % SHORTEST)

# Pieces of a run between separators: of paths, of words, of both.
_PIECES = [re.compile(r"[A-Za-z0-9%s]{%d,}" % (more, SHORTEST)) for more in ("_-", "+/", "")]

# Words, numbers and versions at the ends of a run, with their separators.
_PLAIN = r"(?:[A-Z]?[a-z]{0,15}|[A-Z]{1,15}|v?[0-9]{1,8})"
_BEFORE = re.compile(r"(?:%s[+/_-])+" % _PLAIN)
_AFTER = re.compile(r"(?:[+/_-]%s)+\Z" % _PLAIN)

Span = tuple[str, int, int]

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets in order of size; the first that holds a run is its encoding.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "wide": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_HOLDING = {name: frozenset(symbols) for name, symbols in ENCODINGS.items()}
ENCODINGS |= {f"{name} letters": "".join(c for c in symbols if c not in _DIGITS) for name, symbols in ENCODINGS.items()}
_PLACES = {name: {c: at for at, c in enumerate(symbols)} for name, symbols in ENCODINGS.items()}
_VOWELS, _CAPITALS = frozenset("aeiouAEIOU"), frozenset(_UPPER)
# Share of vowels in the alphabet, and of capitals where it has both cases, of what may be words.
_WORDLIKE = {
    name: (len(_VOWELS & set(symbols)) / len(symbols), len(_CAPITALS & set(symbols)) / len(symbols) if {"a", "A"} <= set(symbols) else None)
    for name, symbols in ENCODINGS.items()
    if name == "wide" or name.endswith(" letters")
}

# Lower ends of the bands of lengths, and bins of p-values.
BANDS = (20, 24, 32, 40, 64, 128)
BINS = 64
# Random candidates after which a stratum's own cut counts as much as the one that holds without any.
_PRIOR = 20


def base_spans(text: str) -> list[Span]:
    """Pattern matches, leftmost and apart within each kind, as ``(kind, start, end)`` in code points."""
    spans: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return spans


def infer_encoding(run: str) -> str | None:
    """The smallest alphabet that holds the run, without its digits if the run has none; none for runs without letters."""
    used = set(run)
    if used <= set(_DIGITS + "+/-_"):
        return None
    name = next((name for name, symbols in _HOLDING.items() if used <= symbols), None)
    return f"{name} letters" if name and used.isdisjoint(_DIGITS) else name


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared_tail(x: float, df: int) -> float:
    """Wilson and Hilferty's normal form of the upper tail."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return math.erfc(z / math.sqrt(2)) / 2


def randomness(run: str, encoding: str) -> float:
    """Combined p-value that the run's symbols are even and independent draws from the encoding."""
    places = _PLACES[encoding]
    values = np.fromiter((places[c] for c in run), np.float64, len(run))
    size, length = len(places), len(values)
    counts = np.bincount(values.astype(np.int64), minlength=size)
    uniform = _chi_squared_tail(float(size / length * (counts**2).sum() - length), size - 1)
    upper = values >= size / 2
    high = int(upper.sum())
    low = length - high
    if high and low:
        mean = 2 * high * low / length + 1
        spread = (mean - 1) * (mean - 2) / (length - 1)
        runs = 1 + int((upper[1:] != upper[:-1]).sum())
        alternation = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        alternation = 2.0 ** (1 - length)
    centred = values - values.mean()
    power = float((centred**2).sum())
    serial = _two_sided(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(length)) if power else 0.0
    tests = [uniform, alternation, serial]
    if encoding in _WORDLIKE:
        tests += _wordless(run, *_WORDLIKE[encoding])
    x = -sum(math.log(max(p, 1e-300)) for p in tests)
    return math.exp(-x) * sum(x**k / math.factorial(k) for k in range(len(tests)))


def _share(found: int, of: int, expected: float) -> float:
    return _two_sided((found - of * expected) / math.sqrt(of * expected * (1 - expected)))


def _wordless(run: str, vowels: float, capitals: float | None) -> list[float]:
    """p-values that vowels, changes between vowels and others, and capitals are as common as in even draws."""
    vowel = [c in _VOWELS for c in run]
    changes = sum(a != b for a, b in zip(vowel, vowel[1:]))
    tests = [_share(sum(vowel), len(run), vowels), _share(changes, len(run) - 1, 2 * vowels * (1 - vowels))]
    if capitals is not None:
        tests.append(_share(sum(c in _CAPITALS for c in run), len(run), capitals))
    return tests


def band(length: int) -> int:
    return sum(length >= low for low in BANDS) - 1


def candidates(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, encoding, p)`` of the runs that may be keys, whole and in pieces between separators."""
    found = []
    for m in _CANDIDATE.finditer(text):
        places = {m.span()}
        if not m[0].isalnum():
            places |= {piece.span() for pattern in _PIECES for piece in pattern.finditer(text, *m.span())}
        for start, end in sorted(places):
            run = text[start:end]
            encoding = infer_encoding(run)
            if encoding:
                found.append((start, end, encoding, randomness(run, encoding)))
    return found


def _may_hold_runs(text: str) -> bool:
    return max(map(len, text.split()), default=0) >= SHORTEST


@dataclass(frozen=True)
class Cuts:
    """Lowest p-value called random for each encoding and band, else ``default``, for runs that may be words ``of_words``."""

    lowest: dict[tuple[str, int], float] = field(default_factory=dict)
    default: float = 0.01
    of_words: float = 0.04

    def accepts(self, length: int, encoding: str, p: float) -> bool:
        default = self.of_words if encoding in _WORDLIKE else self.default
        return p >= self.lowest.get((encoding, band(length)), default)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A random run without plain words at its ends, if enough of it is left."""
    before = _BEFORE.match(text, start, end)
    left = before.end() if before else start
    after = _AFTER.search(text[left:end])
    right = left + after.start() if after else end
    return (left, right) if right - left >= SHORTEST else (start, end)


def find(text: str | None, cuts: Cuts) -> list[Span]:
    """Base spans, and random runs that overlap none of them, by start and then kind.

    Of a random run and random pieces of it the run counts, since a key that holds separators is to go whole;
    plain words before and behind, as in paths, are no part of it.
    """
    text = text or ""
    if not _may_hold_runs(text):  # every hex and access span is such a run; assignments may be short
        spans = base_spans(text) if any(word in text.lower() for word in _ASSIGN_WORDS) else []
        return sorted(spans, key=_order)
    spans = base_spans(text)
    taken = sorted((start, end) for _, start, end in spans)
    random: list[tuple[int, int]] = []
    for start, end, encoding, p in sorted(candidates(text), key=lambda found: found[0] - found[1]):
        if cuts.accepts(end - start, encoding, p) and not any(a < end and start < b for a, b in taken):
            start, end = _trimmed(text, start, end)
            if not any(a <= start and end <= b for a, b in random):
                random.append((start, end))
    spans += [("random", start, end) for start, end in random]
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def cuts_of(counts: dict[tuple[str, int], np.ndarray], q: float) -> Cuts:
    """Cuts from counts of distinct candidates by bin of p, for each encoding and band.

    Neighbouring bands of an encoding lend theirs, half as much for each band between. What few candidates tell is
    mixed with the cut that holds without any, the more of them the less: a stratum with ``_PRIOR`` random ones lies
    halfway. So cuts move evenly as a corpus grows, for runs that may be words as for others.
    """
    lowest = {}
    for encoding in sorted({encoding for encoding, _ in counts}):
        default = Cuts.of_words if encoding in _WORDLIKE else Cuts.default
        for at in range(len(BANDS)):
            bins = sum(0.5 ** abs(other - at) * counts.get((encoding, other), np.zeros(BINS)) for other in range(len(BANDS)))
            upper = bins[BINS // 2 :].sum()
            expected = upper / (BINS - BINS // 2) * np.arange(BINS, 0, -1)
            above = np.cumsum(bins[::-1])[::-1]
            false_share = 1 - np.minimum(1.0, expected / np.maximum(above, 1e-9))
            good = np.nonzero(false_share <= q)[0]
            # The lowest bin is open towards 0, where all that is not random lies.
            told = max(float(good[0]) / BINS, 0.001) if len(good) else default
            weight = upper / (upper + _PRIOR)
            lowest[encoding, at] = math.exp(weight * math.log(told) + (1 - weight) * math.log(default))
    return Cuts(lowest)


def fit_cuts(docs: DataFrame, text_col: str = "text", q: float = 0.05) -> Cuts:
    """Cuts from all distinct candidates of all texts.

    Candidates are counted once each, however often they occur, by a hash of their characters. What
    comes to the driver is one number for each encoding, band and bin.
    """

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows: dict[bytes, tuple[str, int, int]] = {}
                for text in batch.column("text").to_pylist():
                    if _may_hold_runs(text):
                        for start, end, encoding, p in candidates(text):
                            key = sha256(text[start:end].encode()).digest()[:16]
                            rows[key] = (encoding, band(end - start), min(int(p * BINS), BINS - 1))
                columns = zip(*((key, *row) for key, row in rows.items())) if rows else ([], [], [], [])
                kinds = (pa.binary(), pa.string(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], ["key", "encoding", "band", "bin"]
                )

    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = map_batches(texts, run, "key binary, encoding string, band int, bin int")
    once = found.groupBy("key").agg(*[F.min(c).alias(c) for c in ("encoding", "band", "bin")])
    counts: dict[tuple[str, int], np.ndarray] = {}
    for row in once.groupBy("encoding", "band", "bin").count().collect():
        bins = counts.setdefault((row["encoding"], row["band"]), np.zeros(BINS))
        bins[row["bin"]] = row["count"]
    return cuts_of(counts, q)


def scan(docs: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans array<struct<kind, start, end>>)`` for each row; a null or empty text has no spans.

    Spans are in order of their start, those that start together in order of their kind. Repeated rows have theirs
    each, null ids stay null, texts of any length are read whole, and other columns play no part.
    """

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text"):
                spans = [
                    [{"kind": kind, "start": start, "end": end} for kind, start, end in find(text, cuts)]
                    for text in batch.column("text").to_pylist()
                ]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, kind)], ["id", "spans"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans as text."""

    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        id_col,
        *[of(kind) for kind in KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, cuts: Cuts, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each secret span of the text replaced by ``mark``; all else stays as it is.

    Overlapping spans are replaced as one. Null texts stay null, empty ones empty, repeated rows stay as often as they
    are, and texts of any length are searched whole. All other columns go through, whatever their names.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{at}" for at in range(len(names))])
    at_text = f"c{names.index(text_col)}"

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, at_text):
                texts = [text and _without(text, find(text, cuts), mark) for text in batch.column(at_text).to_pylist()]
                at = batch.schema.get_field_index(at_text)
                yield batch.set_column(at, at_text, pa.array(texts, batch.schema.field(at).type))

    return map_batches(rows, run, rows.schema).toDF(*names)


def _without(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda span: span[1:]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
