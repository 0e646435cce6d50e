"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its arc labels.

The automaton starts as one state with an arc to itself for each byte token. Merges are compiled into
it in their order, one merge gadget each: for ``(a, b) -> c`` the state behind ``a`` is split, the new
state keeps all arcs but the one of ``b``, and every state with an arc ``a`` gets an arc ``c`` to the
state behind ``b``. What is left in the end accepts exactly one token sequence for every word: the one
the merges make.

States are shared, not copied. The state behind a token is a chain of splits, each with the merge that
made it and the token it lost; a state taken over by a longer token is the chain up to that merge. An
arc made by a later merge exists where the arc of its left part does. So a state's arcs are read off flat
arrays with one entry for each merge. All pairs of state and token would be two and a half billion arcs for 50,000
tokens; the table of transitions holds those that words have come by, in as many slots as were set aside for it.

A word is encoded left to right. Every prefix of a word has one encoding too, so each byte position has
one state: the one behind the only token that ends there and leaves the state where it starts by an
arc. Tokens that end at a byte are found from the shortest to the longest by a trie of tokens read backwards, whose
arcs are a flat table too. All words of a batch take each step together, by array operations. Time is linear in the
words; the few longer than ``LONG`` bytes go one by one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

# Words beyond this many bytes are encoded one by one.
LONG = 64
# Words that take their steps together: bounds the arrays, and keeps them near the processor. A few go one by one.
TOGETHER = 4096
FEW = 12
# Words and marks that the tokenizer remembers, twice.
WORDS = 30_000
# Slots of the table of transitions; a power of two.
SLOTS = 1 << 20

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class FlatMap:
    """Whole numbers by keys that are whole numbers, not negative, looked up many at a time."""

    def __init__(self, pairs: dict[int, int]):
        bits = max(4, (2 * len(pairs)).bit_length())
        self._shift, size = np.uint64(64 - bits), 1 << bits
        self._keys, self._values = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        keys, values = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        at = self._slots(keys)
        while len(keys):  # one key takes a free slot, the others go on to the next
            free = self._keys[at] == -1
            self._keys[at[free]] = keys[free]
            placed = self._keys[at] == keys
            self._values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self._shift).astype(np.int64)

    def one(self, key: int) -> int:
        """The value of one key; -1 where it is not there."""
        at = (key * int(_SPREAD) & (1 << 64) - 1) >> int(self._shift)
        while (held := self._keys.item(at)) != key:
            if held == -1:
                return -1
            at = at + 1 & len(self._keys) - 1
        return self._values.item(at)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for keys that are not there."""
        at = self._slots(keys)
        held = self._keys[at]
        found = self._values[at]
        other = np.nonzero((held != keys) & (held != -1))[0]
        found[held != keys] = -1
        while len(other):
            at = (at[other] if len(at) != len(other) else at) + 1 & len(self._keys) - 1
            held = self._keys[at]
            here = held == keys[other]
            found[other[here]] = self._values[at[here]]
            on = ~here & (held != -1)
            other, at = other[on], at[on]
        return found


class MergeAutomaton:
    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self._born: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._lost: dict[tuple[int, int], int] = {}
        self._tokens: dict[str, int] = {}
        for token in byte_alphabet():
            if token in vocabulary:
                self._tokens[token] = vocabulary[token]
        for time, (left, right) in enumerate(merges):
            self._gadget(time, self._tokens.get(left), self._tokens.get(right), left + right, vocabulary)
        self._bytes = {ord(shown): byte for shown, byte in byte_alphabet().items()}
        self.labels = {token: self._as_bytes(text) for text, token in self._tokens.items()}
        self._flatten()

    def _as_bytes(self, word: str) -> bytes:
        return word.translate(self._bytes).encode("latin-1")

    def _flatten(self) -> None:
        """The compiled automaton as arrays: merges by token, lost arcs by pair, tokens read backwards."""
        most = max(self.labels, default=0) + 1
        self._age, self._left, self._right = (np.full(most, -1, np.int64) for _ in range(3))
        for token, time in self._born.items():
            self._age[token] = time
            self._left[token], self._right[token] = self._parts[token]
        self._gone = FlatMap({left << 32 | right: time for (left, right), time in self._lost.items()})
        arcs: dict[int, int] = {}
        ending = [-1]
        for token, label in self.labels.items():
            node = 0
            for byte in reversed(label):
                after = arcs.get(node << 8 | byte)
                if after is None:
                    after = arcs[node << 8 | byte] = len(ending)
                    ending.append(-1)
                node = after
            ending[node] = token
        self._backward, self._token_at = FlatMap(arcs), np.array(ending, np.int64)
        self._met: dict[tuple[int, int], bool] = {}  # the same for words that go one by one
        self._known = np.full(SLOTS, -1, np.int64)  # pair of state and token, doubled, and whether there is an arc

    def _gadget(self, time: int, left: int | None, right: int | None, text: str, vocabulary: dict[str, int]) -> None:
        if left is None or right is None or text in self._tokens or not self._arc(left, right):
            return  # no word reaches this merge
        token = vocabulary[text]
        self._tokens[text] = token
        self._born[token] = time
        self._parts[token] = (left, right)
        self._lost[left, right] = time

    def _arc(self, token: int, then: int) -> bool:
        """Whether the state behind ``token`` has an arc for ``then``."""
        born, parts, lost = self._born, self._parts, self._lost
        before = upto = len(born) + len(lost) + (1 << 40)
        while True:
            time = lost.get((token, then))
            if time is not None and time < before and time <= upto:
                return False
            since, made = born.get(token, -1), born.get(then, -1)
            if since < 0 and made < 0:
                return True
            if made >= since:  # the arc came with its left part's arc
                then, upto = parts[then][0], made
            else:  # the state is the one behind the right part, as it was then
                token, before = parts[token][1], since

    def _arcs_of(self, token: np.ndarray, then: np.ndarray) -> np.ndarray:
        """:meth:`_arc` for many pairs at once, from the arrays."""
        token, then = token.copy(), then.copy()
        before = np.full(len(token), 1 << 60, np.int64)
        upto = before.copy()
        out = np.zeros(len(token), bool)
        at = np.arange(len(token))
        while len(at):
            lost = self._gone.get(token << 32 | then)
            on = ~((lost >= 0) & (lost < before) & (lost <= upto))
            since, made = self._age[token], self._age[then]
            single = (since < 0) & (made < 0)
            out[at[on & single]] = True
            on &= ~single
            by_left = made >= since
            token, before = np.where(by_left, token, self._right[token]), np.where(by_left, before, since)
            then, upto = np.where(by_left, self._left[then], then), np.where(by_left, made, upto)
            token, then, before, upto, at = token[on], then[on], before[on], upto[on], at[on]
        return out

    def _allowed(self, token: np.ndarray, then: np.ndarray) -> np.ndarray:
        """Whether there is an arc, by the table of transitions; what it lacks is read off the merges and kept."""
        pairs = token << 32 | then
        at = ((pairs.astype(np.uint64) * _SPREAD) >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)
        held = self._known[at]
        allowed = (held & 1).astype(bool)
        new = np.nonzero(held >> 1 != pairs)[0]
        if len(new):
            allowed[new] = self._arcs_of(token[new], then[new])
            self._known[at[new]] = pairs[new] << 1 | allowed[new]
        return allowed

    def encode(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Tokens of each pre-split word, written in the byte alphabet."""
        words = list(words)
        return dict(zip(words, self.encode_bytes([self._as_bytes(word) for word in words])))

    def encode_bytes(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Tokens of each pre-split word."""
        return [tuple(np.frombuffer(ids, "<u4").tolist()) for ids in self.packed(words)]

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Tokens of each pre-split word, as 32-bit numbers."""
        if len(words) <= FEW:
            return [self._alone(word) for word in words]
        out = [b""] * len(words)
        order = sorted((i for i, word in enumerate(words) if len(word) <= LONG), key=lambda i: -len(words[i]))
        for start in range(0, len(order), TOGETHER):
            some = order[start : start + TOGETHER]
            for i, tokens in zip(some, self._together([words[i] for i in some])):
                out[i] = tokens
        for i, word in enumerate(words):
            if len(word) > LONG:
                out[i] = self._alone(word)
        return out

    def _together(self, words: list[bytes]) -> list[bytes]:
        """Words from the longest to the shortest, a byte of all of them at a time."""
        lengths = np.array([len(word) for word in words])
        most = int(lengths[0])
        letters = np.frombuffer(b"".join(word.ljust(most) for word in words), np.uint8).reshape(len(words), -1).T.astype(np.int64)
        states = np.full((most + 1, len(words)), -1, np.int64)
        origin = np.zeros((most + 1, len(words)), np.int64)
        long = np.searchsorted(-lengths, -np.arange(1, most + 1), "right")  # words with that many bytes
        for end in range(1, most + 1):
            rows = np.arange(long[end - 1])
            nodes = np.zeros(len(rows), np.int64)
            for at in range(end - 1, -1, -1):
                nodes = self._backward.get(nodes << 8 | letters[at, rows])
                if (nodes < 0).any():
                    raise ValueError("the vocabulary lacks a byte of this word")
                tokens = self._token_at[nodes]
                fits = tokens >= 0
                if at:
                    some = np.nonzero(fits)[0]
                    fits[some] = self._allowed(states[at, rows[some]], tokens[some])
                taken = rows[fits]
                states[end, taken], origin[end, taken] = tokens[fits], at
                rows, nodes = rows[~fits], nodes[~fits]
                if not len(rows):
                    break
            if len(rows):
                raise ValueError("the vocabulary lacks a byte of this word")
        columns = []
        at, rows = lengths.copy(), np.arange(len(words))
        while len(rows):
            step = np.full(len(words), -1, np.int64)
            step[rows] = states[at[rows], rows]
            columns.append(step)
            at[rows] = origin[at[rows], rows]
            rows = rows[at[rows] > 0]
        paths = np.stack(columns[::-1], axis=1) if columns else np.zeros((len(words), 0), np.int64)
        taken = paths >= 0
        stops = (4 * taken.sum(axis=1).cumsum()).tolist()
        tokens = paths[taken].astype("<u4").tobytes()
        return [tokens[start:stop] for start, stop in zip([0, *stops], stops)]

    def _alone(self, word: bytes) -> bytes:
        """One word of any length."""
        arc, ending, allowed = self._backward.one, self._token_at.item, self._met
        states, origin = [-1], [0]
        for end in range(1, len(word) + 1):
            node, at = 0, end
            while True:
                at -= 1
                node = arc(node << 8 | word[at]) if at >= 0 else -1
                if node < 0:
                    raise ValueError("the vocabulary lacks a byte of this word")
                token = ending(node)
                if token < 0:
                    continue
                if not at:
                    break
                pair = states[at], token
                if pair not in allowed:
                    if len(allowed) > SLOTS >> 4:
                        allowed.clear()
                    allowed[pair] = self._arc(*pair)
                if allowed[pair]:
                    break
            states.append(token)
            origin.append(at)
        path, at = [], len(word)
        while at:
            path.append(states[at])
            at = origin[at]
        return np.array(path[::-1], "<u4").tobytes()


class ByteBpe:
    """A byte-level tokenizer file as an automaton, with its added tokens."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self._split = Tokenizer.from_str(content.decode()).pre_tokenizer.pre_tokenize_str
        plan = json.loads(content)
        model = plan["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = MergeAutomaton(model["vocab"], merges)
        self.added = {token["content"]: token["id"] for token in plan["added_tokens"]}
        self.labels = self.automaton.labels | {
            token: text.encode() for text, token in self.added.items()
        }
        self._words: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._marks = {token: np.array([token], "<u4").tobytes() for token in self.added.values()}
        self._hidden = {ord(shown): byte for shown, byte in byte_alphabet().items()}
        # No added token is made of letters, so what is has none in it.
        self._letters_are_plain = not any(self._letters(name) for name in self.added)

    @staticmethod
    def _letters(text: str) -> bool:
        """A word of letters, in every version of Unicode, that may follow a blank."""
        letters = text[1:] if text[:1] == " " else text
        return letters.isalpha() and (letters.isascii() or max(letters) < "\u0250")

    def _pre_tokens(self, text: str) -> list[bytes]:
        """The tokenizer's pre-tokens."""
        return [found.translate(self._hidden).encode("latin-1") for found, _ in self._split(text)]

    def _plain(self, text: str) -> list[bytes | int]:
        """Pre-tokens and added tokens, in order."""
        cut: list[bytes | int] = []
        while text:
            found = min(
                ((at, -len(name), name) for name in self.added if (at := text.find(name)) >= 0),
                default=None,
            )
            if found is None:
                return cut + self._pre_tokens(text)
            at, _, name = found
            if at:
                cut += self._pre_tokens(text[:at])
            cut.append(self.added[name])
            text = text[at + len(name) :]
        return cut

    def _simple(self, text: str) -> list[bytes | int] | None:
        """The commonest forms, a word and a word before a comma or stop, are cut here."""
        if self._letters_are_plain and text:
            if self._letters(text):
                return [text.encode()]
            if text[-1] in ",." and self._letters(text[:-1]):
                return [text[:-1].encode(), text[-1].encode()]
        return None

    def _cut(self, texts: list[str]) -> list[list[bytes | int]]:
        cut = list(map(self._simple, texts))
        others = [at for at, row in enumerate(cut) if row is None]
        found = self._cut_together([texts[at] for at in others])
        for at, row in zip(others, found):
            cut[at] = row
        return cut

    def _cut_together(self, texts: list[str]) -> list[list[bytes | int]]:
        """Texts that begin with their only blank and have no other white space at an end are cut as one: just the
        first pre-token of each begins with a blank."""
        whole = "".join(texts)
        if (
            len(texts) < 2
            or any(name in whole for name in self.added)
            or any(
                text.rfind(" ") or len(text) < 2 or text[1].isspace() or text[-1].isspace()
                for text in texts
            )
        ):
            return list(map(self._plain, texts))
        cut: list[list[bytes | int]] = []
        for part in self._pre_tokens(whole):
            if part[:1] == b" ":
                cut.append([part])
            else:
                cut[-1].append(part)
        if len(cut) != len(texts):
            raise ValueError("a part has more than one beginning")
        return cut

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit numbers."""
        if len(self._words) > WORDS:
            self._words, self._old = {}, self._words
        words, old = self._words, self._old
        cut = self._cut(texts)
        parts = {part for row in cut for part in row}
        found = {part: self._marks.get(part) or words.get(part) or old.get(part) for part in parts}
        new = [part for part, ids in found.items() if ids is None]
        found.update(zip(new, self.automaton.packed(new)))
        words.update((part, ids) for part, ids in found.items() if not isinstance(part, int) and len(part) <= 32)
        return [found[row[0]] if len(row) == 1 else b"".join([found[part] for part in row]) for row in cut]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.packed(texts)]

    def decode(self, ids: list[int]) -> bytes:
        """The labels of the arcs taken, one after the other."""
        return b"".join(map(self.labels.__getitem__, ids))

