"""Cut texts where byte-level pre-tokenizers always cut them, and remember what the parts encode to.

A single blank between two characters that are no white space starts a new pre-token, whatever stands
around it. Texts are cut there, and each part is encoded once and remembered, so the work follows the
distinct parts. Arrow splits the texts, finds their distinct parts among those it keeps and joins what they encode to; Python
sees the parts that are new. Parts that begin or end with white space, or are empty, belong to longer runs of it;
texts with such parts are cut by a pattern that keeps the runs whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")

# Longer parts are encoded each time, so that the memory of one entry is bounded.
LONGEST_KEPT = 64


class Remembered:
    """``encode`` of parts. Those kept are two Arrow arrays; beyond ``limit``, parts not used since the last time go.

    ``encode`` gets one part of any kind, or up to ``together`` parts that each begin with a blank and hold no other,
    and have no white space at either end.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[Any]], limit: int = 300_000, together: int = 1000):
        self._encode, self._limit, self._together = encode, limit, together
        self._parts, self._values = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self._used = np.zeros(0, bool)
        self._first: dict[str, Any] = {}

    def _one(self, part: str) -> Any:
        return next(iter(self._encode([part])))

    def _head(self, part: str) -> list[Any]:
        """What the first part of a text, with no blank before it, encodes to."""
        if not part:
            return []
        value = self._first.get(part)
        if value is None:
            value = self._one(part)
            if len(part) <= LONGEST_KEPT:
                if len(self._first) > self._limit // 10:
                    self._first.clear()
                self._first[part] = value
        return [value]

    def _kept(self, parts: pa.Array) -> np.ndarray:
        """Where the parts are kept; -1 for the others."""
        return pc.fill_null(pc.index_in(parts, value_set=self._parts), -1).to_numpy().copy()

    def _forget(self) -> None:
        """Let unused parts go where there are too many."""
        if len(self._parts) > self._limit:
            used = pa.array(self._used)
            self._parts, self._values = self._parts.filter(used), self._values.filter(used)
            self._used = np.zeros(len(self._parts), bool)

    def _numbered(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Values, and the number of the value of each of some distinct parts, with a blank before it; -1 for those
        with white space at an end."""
        self._forget()
        numbers = self._kept(parts)
        self._used[numbers[numbers >= 0]] = True
        missing = np.flatnonzero(numbers < 0)
        names = parts.take(pa.array(missing)).to_pylist()
        closed = [at for at, part in enumerate(names) if part and not (part[0].isspace() or part[-1].isspace())]
        new = [at for at in closed if len(names[at]) <= LONGEST_KEPT]
        values: list[Any] = []
        for start in range(0, len(new), self._together):
            values.extend(self._encode([f" {names[at]}" for at in new[start : start + self._together]]))
        if values:
            self._values = _joined(self._values, values)
            numbers[missing[new]] = np.arange(len(self._parts), len(self._values))
            self._parts = pa.concat_arrays([self._parts, pa.array([names[at] for at in new], pa.string())])
            self._used = np.concatenate([self._used, np.ones(len(new), bool)])
        if len(new) == len(closed):
            return self._values, numbers
        long = [at for at in closed if len(names[at]) > LONGEST_KEPT]
        numbers[missing[long]] = np.arange(len(self._values), len(self._values) + len(long))
        return _joined(self._values, [self._one(f" {names[at]}") for at in long]), numbers

    def _cut_again(self, texts: list[str]) -> list[list[Any]]:
        """Values of the parts of whole texts that are cut by the pattern."""
        cut = [_CUT.split(text) for text in texts]
        others = [part for parts in cut for part in parts[1:]]
        numbers = self._kept(pa.array(others, pa.string()))
        values = self._values.take(pa.array(np.maximum(numbers, 0))).to_pylist() if len(self._values) else others
        for at in np.flatnonzero(numbers < 0).tolist():
            values[at] = self._one(f" {others[at]}")
        rest = iter(values)
        return [self._head(parts[0]) + [next(rest) for _ in parts[1:]] for parts in cut]

    def _found(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, list[list[Any]], np.ndarray]:
        """Values, the number of the value of each part, where the parts of each text end, the values that texts begin
        with, and the texts where these are all: white space at an end of a part needs another cut.

        The others begin with the value of their first part."""
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        parts, of_part = coded.dictionary, coded.indices.to_numpy()
        values, numbers = self._numbered(parts)
        numbers = numbers[of_part]
        is_open = numbers < 0
        is_open[ends[:-1]] = False
        again = np.flatnonzero(np.logical_or.reduceat(is_open, ends[:-1]))
        heads = [self._head(part) for part in parts.take(pa.array(of_part[ends[:-1]])).to_pylist()]
        if len(again):
            for at, found in zip(again.tolist(), self._cut_again(texts.take(pa.array(again)).to_pylist())):
                heads[at] = found
        return values, numbers, ends, heads, again

    def texts(self, texts: list[str]) -> list[list[Any]]:
        """For each text the values of its parts, in order."""
        if not texts:
            return []
        values, numbers, ends, heads, again = self._found(pa.array(texts, pa.string()))
        whole = set(again.tolist())
        return [
            head if at in whole else head + values.take(pa.array(numbers[ends[at] + 1 : ends[at + 1]])).to_pylist()
            for at, head in enumerate(heads)
        ]

    def joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For values that are bytes of 32-bit ids: the ids of all texts, and where those of each end, from 0 on.

        A null text counts as empty.
        """
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        values, numbers, ends, heads, again = self._found(pc.fill_null(texts, "").cast(pa.string()))
        entries = _joined(values, [*(b"".join(head) for head in heads), b""])
        for at in again:
            numbers[ends[at] : ends[at + 1]] = len(entries) - 1
        numbers[ends[:-1]] = np.arange(len(values), len(entries) - 1)
        taken = entries.take(pa.array(numbers))
        stops = np.frombuffer(taken.buffers()[1], np.int64, len(numbers) + 1)
        ids = np.frombuffer(taken.buffers()[2], "<u4", stops[-1] // 4) if stops[-1] else np.zeros(0, "<u4")
        return ids, stops[ends] // 4


def _joined(values: pa.Array, more: list[Any]) -> pa.Array:
    """Values and more of them, all bytes or all of another type."""
    if isinstance(more[0], bytes):
        return pa.concat_arrays([values, pa.array(more, pa.large_binary())])
    return pa.concat_arrays([values, pa.array(more)]) if len(values) else pa.array(more)
