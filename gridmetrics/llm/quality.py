"""Quality rules as a short-circuit cascade.

Each rule is a condition over a text that says when the text fails. On a bounded sample the cascade
measures how long each rule takes and how much it rejects, and puts the rules with the most rejection
per second first. A row's rules are evaluated in that order and stop at the first that fails. The order
changes what is computed, never the verdict.

Everything is DataFrame expressions inside a row: nothing is shuffled, however long or frequent a text.

Null text has no words. Rows come out one for one, so repeated rows, ties and null ids stay. An empty
table, or an empty sample, leaves the rules in the order given. Other columns are not looked at.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm.storage import checkpointed

#: Rows, about, of the sample on which rules are timed, and the seed of its choice. It decides their order only.
SAMPLE_ROWS, SEED = 500, 7
#: Seconds that a rule has to take in a trial, the number of trials, and how often a trial goes through the sample.
LONG_ENOUGH, TRIALS, MOST_TIMES = 0.2, 3, 16
#: Share of an idle trial that cannot be told from its noise: the least cost of a rule.
NOISE = 0.2
#: Factor by which a rule has to be better than the one given before it to overtake it; what clocks on shared machines can tell.
CLEARLY = 8

#: What separates words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: Names of the columns that rules are written over.
TEXT, WORDS = "_quality_text", "_quality_words"


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for texts that the rule rejects."""

    name: str
    fails: Column


def with_words(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with the columns that rules are written over."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return df.withColumns({TEXT: text, WORDS: F.array_remove(F.split(text, SPACE), "")})


def n_words() -> Column:
    return F.size(WORDS).cast("long")


def word_chars() -> Column:
    """Code points in words."""
    return F.length(F.array_join(WORDS, "")).cast("long")


def n_symbols() -> Column:
    return F.regexp_count(TEXT, F.lit(SYMBOLS)).cast("long")


def n_capitals() -> Column:
    return F.regexp_count(TEXT, F.lit("[A-Z]")).cast("long")


def text_lines() -> Column:
    """Lines that have a word."""
    return F.filter(F.split(TEXT, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(lines: Column) -> Column:
    """Lines equal to an earlier one."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words() -> Column:
    """Words in windows of three words that stand in the text twice or more, the first included.

    Windows are compared by a 64-bit hash within their text. Sorted with their places, equal ones are
    neighbours, so a text of n words takes n log n steps whatever it repeats. Most texts stop at the
    test whether any two are equal.
    """
    words = F.col(WORDS)
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    hashes = F.transform(starts, lambda word, at: F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2)))

    def repeated(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda value, at: F.struct(value.alias("value"), at.alias("at"))))
        return F.transform(F.array(placed), _covered)[0]

    return F.transform(
        F.array(hashes),
        lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(repeated(found)),
    )[0].cast("long")


def _covered(placed: Column) -> Column:
    """Words that windows equal to a neighbour cover together."""

    def equal(value: Column, at: Column, step: int) -> Column:
        return F.coalesce(F.get(placed, at + step)["value"] == value["value"], F.lit(False))

    twice = F.filter(placed, lambda value, at: equal(value, at, -1) | equal(value, at, 1))
    starts = F.sort_array(F.transform(twice, lambda value: value["at"]))
    return F.transform(
        F.array(starts),
        lambda s: F.aggregate(
            F.transform(s, lambda start, i: F.least(F.lit(3), start - F.coalesce(F.get(s, i - 1), start - 3))),
            F.lit(0),
            lambda total, n: total + n,
        ),
    )[0]


def default_rules() -> list[Rule]:
    """The rules in production; the thresholds keep ordinary prose of any length from 50 words on."""
    return [
        Rule("too_short", n_words() < 50),
        Rule("symbols", 100 * n_symbols() > 10 * word_chars()),
        Rule("capitals", 100 * n_capitals() > 30 * word_chars()),
        Rule("word_length", (word_chars() < 2 * n_words()) | (word_chars() > 15 * n_words())),
        Rule("repeated_lines", 100 * n_dup_lines(text_lines()) > 40 * F.size(text_lines())),
        Rule("repeated_words", 100 * n_repeat_words() > 50 * n_words()),
    ]


def measured(sample: DataFrame, condition: Column, times: int) -> tuple[float, int]:
    """Seconds to evaluate a condition on every row of the sample ``times`` times over, and how many rows meet it."""
    again = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_time"))
    began = time.perf_counter()
    met = again.agg(F.count_if(condition).alias("n")).first()["n"]
    return time.perf_counter() - began, met // times


def costs(sample: DataFrame, rules: list[Rule]) -> dict[str, tuple[float, int]]:
    """Seconds that each rule takes for the sample, and the rows that it rejects.

    The sample is gone through so often that the rule should take long enough for the clock; the time of as
    many passes with a condition that costs nothing is taken off. The least of several trials counts:
    whatever else the machine does only adds to a time.
    """
    nothing, idle, found = F.size(WORDS) < 0, {}, {}
    measured(sample, nothing, 1)  # start-up is nobody's cost

    def least(condition: Column, times: int) -> float:
        return min(measured(sample, condition, times)[0] for _ in range(TRIALS))

    idle[1] = least(nothing, 1)
    for rule in rules:
        seconds, rejected = measured(sample, rule.fails, 1)
        times = min(MOST_TIMES, max(1, ceil(LONG_ENOUGH / max(seconds - idle[1], 0.001))))
        times = 1 << (times - 1).bit_length()  # few different numbers, each with an idle time of its own
        if times not in idle:
            idle[times] = least(nothing, times)
        own = least(rule.fails, times) - idle[times]
        found[rule.name] = (max(own, NOISE * idle[times]) / times, rejected)
    return found


def ordered(texts: DataFrame, rules: list[Rule], sample_rows: int) -> list[Rule]:
    """``rules`` by rejection per cost on a random sample of a column ``text``, of about ``sample_rows`` rows.

    A rule overtakes those given before it that are clearly worse, and every rule those that reject nothing; else
    the order given stays, so that the clock's noise does not decide.
    """
    count = texts.count()
    if not count or len(rules) < 2:
        return rules
    sample = checkpointed(texts.select("text").sample(min(1.0, sample_rows / count), SEED).coalesce(1))
    sample = with_words(sample).select(TEXT, WORDS)
    if sample.isEmpty():
        return rules
    rates = {name: rejected / seconds for name, (seconds, rejected) in costs(sample, rules).items()}
    order: list[Rule] = []
    for rule in rules:
        at = len(order)
        while at and rates[rule.name] > CLEARLY * rates[order[at - 1].name]:
            at -= 1
        order.insert(at, rule)
    return order


def first_failed(rules: list[Rule]) -> Column:
    """The name of the first rule that a text fails, null if it fails none; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.fails, F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality_cascade(docs: DataFrame, rules: list[Rule] | None = None, text_column: str = "text", sample_rows: int = SAMPLE_ROWS, name: str = "failed_rule") -> DataFrame:
    """``docs`` with the rule that rejects each row, null for those that all rules keep."""
    rules = default_rules() if rules is None else rules
    rules = ordered(docs.select(F.col(text_column).alias("text")), rules, sample_rows)
    # As a generator's column the verdict is evaluated once; as a plain one, a filter on it would copy its whole expression.
    return with_words(docs, text_column).withColumn(name, F.explode(F.array(first_failed(rules)))).drop(TEXT, WORDS)


def quality_report(docs: DataFrame, rules: list[Rule] | None = None, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row the id, the counts, ``base_failed`` (too short or half repeated), ``kept`` and ``failed_rule``."""
    rules = default_rules() if rules is None else rules
    source = with_words(docs.select(F.col(id_column), F.col(text_column).alias("text")))
    rules = ordered(docs.select(F.col(text_column).alias("text")), [r for r in rules if r.name not in ("too_short", "repeated_words")], sample_rows)
    counted = source.select(
        id_column,
        TEXT,
        WORDS,
        n_words().alias("n_words"),
        word_chars().alias("word_chars"),
        n_symbols().alias("n_symbols"),
        n_dup_lines(text_lines()).alias("n_dup_lines"),
        n_repeat_words().alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(first_failed(rules))
    counted = counted.withColumn("base_failed", failed).withColumn("failed_rule", verdict)
    return counted.withColumn("kept", F.col("failed_rule").isNull()).drop(TEXT, WORDS)
