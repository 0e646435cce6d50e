"""Operator 1: quality rules, a table of thresholds compiled into one projection of column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.llm.runtime import WORD

# Common words of the languages the rules serve.
STOP_WORDS = {
    "de": "als auch auf aus bei das dem den der des die ein eine es für im in ist mit nicht sich sie und von zu",
    "en": "a an and are as at be by for from he his in is it not of on or that the this to was were which with",
    "es": "al con de del el en es la las lo los no para por que se su sus un una y",
    "fr": "au ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une",
}

# Windows of so many words that occur twice in a text count as repetition.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A text passes when ``low <= metric <= high``; texts of fewer than ``from_words`` words pass anyway."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 1


# The base: these two decide base_failed and are written as whole numbers.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.5, 12.0),
    Rule("symbol_ratio", "n_symbols / n_words", high=0.1),
    Rule("exclamation_ratio", "n_exclamations / n_words", high=0.3),
    Rule("stop_word_ratio", "n_stop_words / n_words", low=0.06, from_words=50),
    Rule("duplicate_line_ratio", "n_dup_lines / n_lines", high=0.4),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines / n_lines", high=0.3),
    Rule("bullet_line_ratio", "n_bullet_lines / n_lines", high=0.9),
)

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_stop_words n_exclamations"
    " n_ellipsis_lines n_bullet_lines"
).split()

_BLANKS = " \t\n\u000b\f\r"


def stop_words() -> list[str]:
    return sorted({word for words in STOP_WORDS.values() for word in words.split()})


def condition(rule: Rule) -> str:
    """The rule as SQL over the counts; the same text serves Spark and the SQL twin."""
    metric = f"({rule.metric.replace(' / ', ' * 1e0 / ')})"
    limits = [f"{metric} >= {rule.low:.3e}"] if rule.low is not None else []
    limits += [f"{metric} <= {rule.high:.3e}"] if rule.high is not None else []
    return f"(n_words < {rule.from_words} or n_lines = 0 or ({' and '.join(limits)}))"


def base_condition() -> str:
    return f"(n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)"


def _count(array: Column) -> Column:
    return F.size(array).cast("bigint")


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of each row with the counts the rules are made of, by column expressions alone.

    Equal windows are found by a 64-bit hash of their words. Only texts where a hash comes twice sort
    their windows, to count the words they cover.
    """
    kept = [F.col(name).alias(f"keep{at}") for at, name in enumerate(keep)]
    names = [f"keep{at}" for at in range(len(keep))]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(*kept, text.alias("text")).select(
        *names,
        "text",
        F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashed = texts.select(
        *names,
        "text",
        "words",
        "lines",
        F.when(
            F.size("words") >= WINDOW,
            F.transform(starts, lambda at: F.xxhash64(*[F.get("words", at + k) for k in range(WINDOW)])),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    counted = hashed.select(
        *names,
        _count(F.col("words")).alias("n_words"),
        F.length(F.translate("text", _BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, at: F.struct(h.alias("h"), at.alias("at")))),
        ).alias("sorted"),
        _count(F.col("lines")).alias("n_lines"),
        _count(F.filter("words", lambda w: F.lower(w).isin(stop_words()))).alias("n_stop_words"),
        (F.length("text") - F.length(F.translate("text", "!", ""))).cast("bigint").alias("n_exclamations"),
        _count(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).alias("n_ellipsis_lines"),
        _count(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•]\s"))).alias("n_bullet_lines"),
    )

    def twice(row: Column, at: Column) -> Column:
        before, after = F.get("sorted", at - 1)["h"], F.get("sorted", at + 1)["h"]
        return F.coalesce(row["h"] == before, F.lit(False)) | F.coalesce(row["h"] == after, F.lit(False))

    found = F.sort_array(F.transform(F.filter("sorted", twice), lambda row: row["at"]))
    marked = counted.withColumn("repeated", F.when(F.col("sorted").isNotNull(), found)).drop("sorted")

    def covered(start: Column, at: Column) -> Column:
        following = F.coalesce(F.get("repeated", at + 1), start + WINDOW)
        return F.least(F.lit(WINDOW), following - start)

    repeats = F.aggregate(F.transform("repeated", covered), F.lit(0), lambda total, n: total + n)
    counts = marked.withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0)).cast("bigint"))
    return counts.select(*[F.col(f"keep{at}").alias(name) for at, name in enumerate(keep)], *COUNTS)


def judge(
    docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed``, ``failed`` (names of the rules broken) and ``kept``.

    A null, empty or blank text has no words: it fails the base and breaks no other rule. Rows are judged
    by themselves, so repeated rows get equal verdicts; nothing is shuffled. Texts of any length are measured whole.
    """
    failed = F.array_compact(
        F.array(*[F.when(~F.expr(condition(rule)), F.lit(rule.name)) for rule in rules])
        if rules
        else F.array().cast("array<string>")
    )
    judged = measure(docs, text_col, keep).withColumns(
        {"base_failed": F.expr(base_condition()), "failed": failed}
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


RESULT = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()

_LISTED = ", ".join(f"'{word}'" for word in stop_words())
SQL = f"""
with texts as (
  select row_number() over () as row_id, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines
  from documents
),
starts as (
  select row_id, words, unnest(range(1, len(words) - {WINDOW} + 2)) as place from texts where len(words) >= {WINDOW}
),
windows as (select row_id, place, words[place:place + {WINDOW - 1}] as win from starts),
twice as (select row_id, place, count(*) over (partition by row_id, win) as n from windows),
covered as (
  select row_id, count(distinct place + k) as n_repeat_words
  from twice, (select unnest(range({WINDOW})) as k) where n > 1 group by row_id
),
counts as (
  select doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    len(lines) as n_lines,
    len(list_filter(words, lambda w: lower(w) in ({_LISTED}))) as n_stop_words,
    length(text) - length(replace(text, '!', '')) as n_exclamations,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) as n_ellipsis_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]\\s'))) as n_bullet_lines
  from texts left join covered using (row_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {base_condition()} as base_failed,
  not {base_condition()} and {" and ".join(condition(rule) for rule in RULES)} as kept
from counts
"""
