"""Operator 2: language of texts, by known words first and shorter and shorter character n-grams else.

Which language is told by odds among the learned languages; they say nothing of texts in none of them.
Whether a text is in that language at all is told by its fit: the mean log probability of its letters,
each given the letters after it, set against the fits of the labelled texts the model learned from.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.llm.bpe_automaton import FlatMap
from wickframe.llm.runtime import Batches, kept, map_batches, slices

UNDETERMINED = "und"

# Positions and words looked up at a time, and numbers kept of words that were: they bound memory.
_POSITIONS, _TOGETHER, _KEPT = 1 << 16, 20_000, 1 << 19
_MIX, _SIGN = np.uint64(0x9E3779B97F4A7C15), np.uint64(2)

# A word is a run of letters; ^ and $ mark its ends in n-grams.
_LETTERS = r"[\p{L}\p{M}]+"
_letters = re.compile(r"[^\W\d_]+")
LONGEST_GRAM = 4

# One unseen occurrence counts as so many seen ones, and the part of frequencies that all keys share.
_SMOOTHING = 0.5
_UNSEEN = 0.05

# Words of a text are not independent; at most so many count as independent evidence in the odds.
_INDEPENDENT_WORDS = 20.0

# A letter whose longest n-gram is unknown takes the next shorter one's probability, so much less in logs
# for each letter left out; a letter that no language knows takes the last.
_BACKOFF, _UNKNOWN = -1.0, -12.0

# How far a text's fit may lie below the typical one, in spreads of labelled texts, for a score of one half.
_FAR = 8.0
# Labelled texts whose fits tell the typical one and its spread, and how many a language needs of its own.
_JUDGED_TEXTS, _FEWEST_TEXTS = 2_000, 20
# Labelled rows of a language that are counted at least, if it has as many.
_FEWEST_ROWS = 200


@dataclass
class LanguageModel:
    """Per-language log frequencies of words and of character n-grams."""

    languages: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    # Log probability of each n-gram's first letter given the others, by language.
    letter_logs: np.ndarray | None = None
    # Typical fit, its variance times letters within texts, and its variance between texts, by language.
    typical: np.ndarray | None = None
    _lookup: list[FlatMap] | None = field(default=None, repr=False)
    _seen: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)

    def _letters_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all words, each between its marks, and where the words start."""
        joined = "".join([f"^{word}$" for word in words])
        starts = np.cumsum([0, *(len(word) + 2 for word in words)])
        return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), starts

    def _longest(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(owners, rows, left_out)`` for the positions of all words, some at a time.

        A row is that of the longest known n-gram that starts at a position, or -1; ``left_out`` counts the letters
        it lacks of the longest possible. The mark of a word's start alone is no n-gram: it is in every language.
        """
        letters, starts = self._letters_of(words)
        if self._lookup is None:
            self._lookup = [
                FlatMap({int(_gram_key(gram)): row for gram, row in self.grams.items() if len(gram) == size})
                for size in range(1, LONGEST_GRAM + 1)
            ]
        for low in range(0, len(letters), _POSITIONS):
            at = np.arange(low, min(low + _POSITIONS, len(letters)))
            owners = np.searchsorted(starts, at, "right") - 1
            room = np.minimum(LONGEST_GRAM, starts[owners + 1] - at)
            own = room > 1  # the mark of an end starts nothing
            at, owners, room = at[own], owners[own], room[own]
            least = np.where(at == starts[owners], 2, 1)
            rows = np.full(len(at), -1, np.int64)
            left_out = np.zeros(len(at), np.int64)
            keys = [np.zeros(len(at), np.uint64)]
            for size in range(LONGEST_GRAM):
                keys.append(_mixed(keys[-1], letters[np.minimum(at + size, len(letters) - 1)]))
            for size in range(LONGEST_GRAM, 0, -1):
                open_ = np.nonzero((rows < 0) & (room >= size) & (least <= size))[0]
                found = self._lookup[size - 1].get((keys[size][open_] >> _SIGN).astype(np.int64))
                rows[open_] = found
                left_out[open_[found >= 0]] = room[open_[found >= 0]] - size
            yield owners, rows, left_out

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the word's positions of the longest known n-gram that starts there."""
        return self._fresh([word], known=False)[0, : len(self.languages)]

    def _fresh(self, words: list[str], known: bool = True) -> np.ndarray:
        """A row for each word: log frequencies by language, and for a model that judges fits, its letters' log
        probabilities and their number too."""
        size, judges = len(self.languages), self.letter_logs is not None
        grams, counts = np.zeros((len(words), size)), np.zeros(len(words))
        likely, lacking = np.zeros((len(words), size)), np.zeros(len(words))
        for owners, rows, left_out in self._longest(words):
            found = rows >= 0
            here, of = rows[found], owners[found]
            counts += np.bincount(of, minlength=len(words))
            _add_runs(grams, of, self.gram_logs, here)
            if judges:
                _add_runs(likely, of, self.letter_logs, here)
                lacking += _BACKOFF * np.bincount(of, left_out[found], len(words))
                lacking += _UNKNOWN * np.bincount(owners[~found], minlength=len(words))
        logs = grams / np.maximum(counts, 1)[:, None]
        likely += lacking[:, None]
        if known:
            rows = np.array([self.words.get(word, -1) for word in words], np.int64)
            at = np.nonzero(rows >= 0)[0]
            logs[at] = self.word_logs[rows[at]]
            likely[at] = np.maximum(likely[at], logs[at])
        if not judges:
            return logs
        return np.column_stack([logs, likely, [len(word) + 1 for word in words]])

    def forget(self) -> None:
        """Let go of the rows of words: a worker may go on with other work."""
        self._seen, self._rows = {}, None

    def _vectors(self, words: list[str]) -> np.ndarray:
        """The rows of words, kept from call to call."""
        width = len(self.languages) * (1 if self.letter_logs is None else 2) + (self.letter_logs is not None)
        most = max(10_000, _KEPT // width)
        if self._rows is None or len(self._seen) > most:
            self._seen = {}
            self._rows = np.zeros((1024, width))
        get = self._seen.get
        rows = list(map(get, words))
        if None in rows:
            new = list(dict.fromkeys(word for word, row in zip(words, rows) if row is None))
            start = len(self._seen)
            need = start + len(new)
            if need > len(self._rows):
                grown = np.zeros((max(need, min(2 * len(self._rows), most)), width))
                grown[:start] = self._rows[:start]
                self._rows = grown
            self._rows[start:need] = self._fresh(new)
            self._seen.update(zip(new, range(start, need)))
            rows = list(map(get, words))
        return self._rows[rows]

    def _score(self, language: int, letters: float, count: float) -> float:
        """Near 1 for a fit like those of labelled texts, one half at ``_FAR`` spreads below; short texts spread more."""
        mean, within, between = self.typical[language]
        below = (mean - letters / count) / math.sqrt(within / count + between)
        return 1 / (1 + math.exp(min(max(below - _FAR, -50.0), 50.0)))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """``(language, score)`` of each text; ties go to the first language in order of name.

        The score tells how well the text fits the language, whatever the others are. A model that did not
        see labelled texts to judge by gives the odds of the language among those learned. Words of many texts
        are looked up together, and texts of very many words part by part.
        """
        words: list[str] = []
        counts, sums = [], {}
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        pending: list[int] = []

        def add_up() -> None:
            if words:
                rows = self._vectors(words)
                of = np.repeat(np.arange(len(pending)), [counts[at] for at in pending])
                total = np.zeros((len(pending), rows.shape[1]))
                _add_runs(total, of, rows, None)
                for at, row in zip(pending, total):
                    sums[at] = row
            words.clear()
            pending.clear()

        for at, text in enumerate(texts):
            found = _letters.findall((text or "").lower())
            counts.append(len(found))
            if len(found) > _TOGETHER:
                parts = range(0, len(found), _TOGETHER)
                sums[at] = sum(self._vectors(found[low : low + _TOGETHER]).sum(axis=0) for low in parts)
            elif found:
                pending.append(at)
                words += found
                if len(words) > _TOGETHER:
                    add_up()
        add_up()
        return [self._judged(sums[at], counts[at]) if counts[at] else (UNDETERMINED, 0.0) for at in range(len(texts))]

    def _judged(self, sums: np.ndarray, words: int) -> tuple[str, float]:
        total = sums[: len(self.languages)]
        best = int(np.argmax(total))
        if self.typical is not None:
            return self.languages[best], self._score(best, float(sums[len(total) + best]), float(sums[-1]))
        shown = total * min(1.0, _INDEPENDENT_WORDS / words)
        odds = np.exp(shown - shown.max())
        return self.languages[best], float(odds[best] / odds.sum())


def _mixed(keys: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The keys of n-grams one letter longer."""
    keys = (keys ^ (letters + np.uint64(1))) * _MIX
    return keys ^ (keys >> np.uint64(29))


def _gram_key(gram: str) -> int:
    """62 bits that stand for an n-gram among those of its length."""
    key = np.zeros(1, np.uint64)
    for letter in gram:
        key = _mixed(key, np.array([ord(letter)], np.uint64))
    return int(key[0] >> _SIGN)


def _add_runs(into: np.ndarray, owners: np.ndarray, values: np.ndarray, rows: np.ndarray | None) -> None:
    """Add rows of ``values`` to those of their owners, who come in rising order."""
    if len(owners):
        starts = np.nonzero(np.diff(owners, prepend=-1))[0]
        into[owners[starts]] += np.add.reduceat(values if rows is None else values[rows], starts, axis=0)


def _tables(counts: list, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Rows ``(lang, key, n)`` as key numbers and log frequencies.

    Every language lends the part ``_UNSEEN`` of its frequencies to all keys alike. So a key that a language never
    had is as unlikely there as in any other, however much or little was read of it.
    """
    keys = {key: at for at, key in enumerate(sorted({row[1] for row in counts}))}
    column = {language: at for at, language in enumerate(languages)}
    found = np.zeros((len(keys), len(languages)))
    for language, key, n in counts:
        found[keys[key], column[language]] = n
    totals = np.maximum(found.sum(axis=0), 1)
    return keys, np.log((1 - _UNSEEN) * found / totals + _UNSEEN / max(1, len(keys)))


def _letter_logs(counts: list, grams: dict[str, int], languages: list[str]) -> np.ndarray:
    """Log probability of each n-gram's first letter given the others, smoothed by that given one less."""
    column = {language: at for at, language in enumerate(languages)}
    found = np.zeros((len(grams) + 1, len(languages)))  # the last row stands for n-grams that are not known
    for language, key, n in counts:
        found[grams[key], column[language]] = n
    ends = found[grams["^"]] if "^" in grams else found[-1]
    first = [at for key, at in grams.items() if len(key) == 1]
    likely = np.zeros_like(found)
    likely[first] = (found[first] + _SMOOTHING) / (found[first].sum(axis=0) + _SMOOTHING * (len(first) + 1))
    likely[-1] = math.exp(_UNKNOWN)
    for size in range(2, LONGEST_GRAM + 1):
        keys = [key for key in grams if len(key) == size]
        if keys:
            at = [grams[key] for key in keys]
            after = found[[grams.get(key[1:], -1) for key in keys]]
            after[[key[1:] == "$" for key in keys]] = ends
            shorter = likely[[grams.get(key[:-1], -1) for key in keys]]
            likely[at] = (found[at] + shorter) / (np.maximum(after, found[at]) + 1)
    return np.log(likely[:-1])


def _typical(texts: list, languages: list[str]) -> np.ndarray | None:
    """Fits of labelled texts by language, from rows ``(lang, letters, count, letters², letters·count, count²)``.

    Medians, so that junk among the labelled texts moves nothing. A language with few texts takes what all
    texts together give.
    """

    def of(rows: np.ndarray) -> tuple[float, float, float]:
        fits = rows[:, 0] / rows[:, 1]
        weight = np.sqrt(rows[:, 1])
        order = np.argsort(fits)
        passed = np.cumsum(weight[order])
        mean = float(fits[order][np.searchsorted(passed, passed[-1] / 2)])
        apart = rows[:, 2] - 2 * mean * rows[:, 3] + mean**2 * rows[:, 4]
        within = float(np.median(np.maximum(apart, 0) / rows[:, 1]))
        long = rows[:, 1] >= np.median(rows[:, 1])
        between = (1.4826 * float(np.median(np.abs(fits[long] - mean)))) ** 2
        # Equal texts have no spread; a text is never judged by less than this.
        return mean, max(within, 0.25), max(between, 0.0625)

    if not texts:
        return None
    names = np.array([row[0] for row in texts])
    rows = np.array([row[1:] for row in texts], dtype=float)
    own = [rows[names == language] for language in languages]
    return np.array([of(mine if len(mine) >= _FEWEST_TEXTS else rows) for mine in own])


def _shared(spark: SparkSession, model: LanguageModel) -> Callable[[], LanguageModel]:
    """What gives the model in a task. Workers build it from packed bytes and keep it until they do other work."""
    packed = spark.sparkContext.broadcast(zlib.compress(pickle.dumps(model, pickle.HIGHEST_PROTOCOL), 1))
    key = ("language", uuid.uuid4().hex)
    return lambda: kept(key, lambda: pickle.loads(zlib.decompress(packed.value)))


def _judged(labelled: DataFrame, model: LanguageModel) -> list:
    """What ``_typical`` takes, of ``labelled`` rows ``(lang, text)``."""
    shared = _shared(labelled.sparkSession, model)
    names = ("letters", "n", "letters2", "lettersn", "n2")

    def run(batches: Batches) -> Batches:
        model = shared()
        column = {language: at for at, language in enumerate(model.languages, len(model.languages))}
        for whole in batches:
            for batch in slices(whole, "text"):
                found = []
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    sums = np.zeros(5)
                    words = _letters.findall(text)
                    for start in range(0, len(words), 50_000):
                        rows = model._vectors(words[start : start + 50_000])
                        letters, n = rows[:, column[lang]], rows[:, -1]
                        sums += letters.sum(), n.sum(), letters @ letters, letters @ n, n @ n
                    if words:
                        found.append((lang, *sums.tolist()))
                columns = list(zip(*found)) or [()] * 6
                kinds = [pa.string(), *[pa.float64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", *names])
        model.forget()

    schema = "lang string, " + ", ".join(f"{name} double" for name in names)
    return [tuple(row) for row in map_batches(labelled, run, schema, keeps=True).collect()]


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    key_cols: tuple[str, ...] = ("doc_id",),
    sample_rows: int = 10_000,
) -> LanguageModel:
    """Learn from a bounded sample of rows with a text and a language.

    ``sample_rows`` bounds the labelled rows that are counted, in Spark: each language has an equal share of them, at
    least ``_FEWEST_ROWS`` rows, picked by a hash of ``key_cols`` and the text, and all it has where that is fewer. So a
    language that is rare in the table is learned as well as a common one. All languages, all words that come
    more than once in the sample and all n-grams make the model. An n-gram counts once for each occurrence of a
    word, so a very long word counts like any other. No labelled rows give a model without languages. Fits are
    judged by about ``_JUDGED_TEXTS`` labelled rows, shared out alike, others than were counted where there are more.
    """
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.lower(F.col(text_col).cast("string")).alias("text"),
        (F.abs(F.xxhash64(*key_cols, text_col) % 1_000_003) / 1_000_003).alias("draw"),
    ).where("lang is not null and text is not null")
    # One row for each language.
    held = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    languages = sorted(held)
    if not languages:
        return LanguageModel([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    quota = max(_FEWEST_ROWS, sample_rows // len(languages))
    checked = max(_FEWEST_TEXTS, _JUDGED_TEXTS // len(languages))
    shares = []
    for language in languages:
        share, some = min(1.0, quota / held[language]), min(1.0, checked / held[language])
        start = min(share, 1.0 - some)
        shares.append((language, share, start, start + some))
    shares_of = labelled.sparkSession.createDataFrame(shares, "lang string, share double, low double, high double")
    rows = rows.join(F.broadcast(shares_of), "lang")
    words = (
        rows.where("draw < share")
        .select("lang", F.explode(F.regexp_extract_all("text", F.lit(_LETTERS), 0)).alias("key"))
        .groupBy("lang", "key")
        .agg(F.count("*").alias("n"))
    )
    marked = F.concat(F.lit("^"), "key", F.lit("$"))

    def pieces(size: int) -> Column:
        """All n-grams of a size; the mark of an end alone is none, and short words have none of four letters."""
        places = F.sequence(F.lit(1), F.length("word") - max(1, size - 1))
        found = F.transform(places, lambda at: F.substring("word", at, F.lit(size)))
        return F.when(F.length("word") >= size, found).otherwise(F.array().cast("array<string>"))

    every = F.concat(*(pieces(size) for size in range(1, LONGEST_GRAM + 1)))
    grams = (
        words.select("lang", "n", marked.alias("word"))
        .select("lang", "n", F.explode(F.array_distinct(every)).alias("key"))
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
    )

    def counted(counts: DataFrame) -> list:
        found = counts.select("lang", "key", "n").toArrow().to_pydict()
        return list(zip(found["lang"], found["key"], found["n"]))

    word_rows, word_logs = _tables(counted(words.where("n > 1")), languages)
    all_grams = counted(grams)
    gram_rows, gram_logs = _tables(all_grams, languages)
    model = LanguageModel(languages, word_rows, word_logs, gram_rows, gram_logs)
    if not all_grams:
        return model
    model.letter_logs = _letter_logs(all_grams, gram_rows, languages)
    judged = rows.where("draw >= low and draw < high").select("lang", "text")
    model.typical = _typical(_judged(judged, model), languages)
    return model


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of each row with ``lang_pred`` and ``score`` from the whole text.

    A null text or one without letters is ``und`` with score 0; so is every text under a model without
    languages. Ties go to the first language in order of name. No shuffle; rows are independent of each other, repeated
    ones too, texts of any length are judged whole, part by part, and columns that are not kept play no part.
    """
    names = [f"keep{at}" for at in range(len(keep))]
    rows = docs.select(
        *[F.col(name).alias(new) for name, new in zip(keep, names)],
        F.col(text_col).cast("string").alias("text_to_judge"),
    )
    shared = _shared(docs.sparkSession, model)

    def run(batches: Batches) -> Batches:
        model = shared()
        for whole in batches:
            for batch in slices(whole, "text_to_judge"):
                found = model.predict_all(batch.column("text_to_judge").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(name) for name in names],
                        pa.array([language for language, _ in found], pa.string()),
                        pa.array([score for _, score in found], pa.float64()),
                    ],
                    [*names, "lang_pred", "score"],
                )
        model.forget()

    schema = rows.drop("text_to_judge").schema.add("lang_pred", "string").add("score", "double")
    return map_batches(rows, run, schema, keeps=True).toDF(*keep, "lang_pred", "score")


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.35) -> DataFrame:
    """``docs`` without the rows whose text is undetermined or scores less than ``min_score``; columns as they are.

    Scores are fits to the language, so texts in no learned language go, however many were learned. A model without languages tells nothing: then all texts with letters stay.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{at}" for at in range(len(names))])
    at_text = f"c{names.index(text_col)}"
    shared = _shared(docs.sparkSession, model)

    def run(batches: Batches) -> Batches:
        model = shared()
        for whole in batches:
            for batch in slices(whole, at_text):
                texts = batch.column(at_text).to_pylist()
                if model.languages:
                    found = model.predict_all(texts)
                    sure = [language != UNDETERMINED and score >= min_score for language, score in found]
                else:
                    sure = [_letters.search(text or "") is not None for text in texts]
                yield batch.filter(pa.array(sure, pa.bool_()))
        model.forget()

    return map_batches(rows, run, rows.schema, keeps=True).toDF(*names)


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit_on_documents(docs: DataFrame) -> LanguageModel:
    """The model of the queries: labelled documents that are not held out."""
    return fit(docs.where(~held_out()))
