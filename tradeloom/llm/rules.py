"""Learned decision lists over text statistics: sequential covering with threshold conjunctions.

Statistics and rules are plain column expressions; the learner reads counts that Spark
aggregates and holds nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import stage, table, text_or_empty, words

# Limits of the base rule. Fixed by the contract.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

BINS = 24
MOST_RULES = 12
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.85
LEAST_ROWS = 5


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add counts of the whole text; 0 throughout for NULL and empty texts.

    `n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words` are those of the contract;
    `n_upper, n_marks, n_distinct_words` serve the learner. Windows of three words are compared by
    a 64-bit hash, of which a text of n words keeps 64 - log2(n) bits.
    """
    whole = text_or_empty(text)
    first = df.withColumns({"_words": words(whole), "_lines": F.split(whole, "\n")})
    lines = F.filter("_lines", lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    n = F.size("_words")

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2))

    counted = first.withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("bigint"),
            "n_upper": F.length(F.regexp_replace(whole, "[^A-Z]+", "")).cast("bigint"),
            "n_marks": F.length(F.regexp_replace(whole, "[^!?]+", "")).cast("bigint"),
            "n_distinct_words": F.size(F.array_distinct("_words")).cast("bigint"),
            "_filled": lines,
            "_windows": F.slice(F.transform("_words", window), F.lit(1), F.greatest(n - 2, F.lit(0))),
        }
    ).drop("_words", "_lines")
    doubled = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # hash above, place below, in one long: equal windows become neighbours by a plain sort
    bits = F.ceil(F.log2(F.size("_windows") + F.lit(1))).cast("int")
    packed = F.sort_array(
        F.transform("_windows", lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("bigint")))
    )
    listed = (
        counted.withColumn("n_dup_lines", (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("bigint"))
        .withColumn("_bits", bits)
        .withColumn("_packed", F.when(doubled, packed).otherwise(F.array().cast("array<bigint>")))
        .drop("_filled", "_windows")
    )

    def same(a: Column, b: Column) -> Column:
        return F.call_function("shiftright", a, F.col("_bits")) == F.call_function("shiftright", b, F.col("_bits"))

    def repeated(x: Column, i: Column) -> Column:
        before = F.coalesce(same(x, F.get("_packed", i - 1)), F.lit(False))
        return before | F.coalesce(same(x, F.get("_packed", i + 1)), F.lit(False))

    mask = F.call_function("shiftleft", _long(1), F.col("_bits")) - 1
    places = F.sort_array(F.transform(F.filter("_packed", repeated), lambda x: x.bitwiseAND(mask)))
    # a window covers three words, less where the next repeated one starts
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(_long(3), F.coalesce(F.get("_places", i + 1) - p, _long(3)))),
        _long(0),
        lambda total, x: total + x,
    )
    return (
        listed.withColumn("_places", places)
        .withColumn("n_repeat_words", covered)
        .drop("_packed", "_places", "_bits")
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )


def features() -> dict[str, Column]:
    """Scale-free statistics that the rules compare with thresholds; 0 for a text without words."""

    def share(part: Column, of: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), of.cast("double")), F.lit(0.0))

    n = F.col("n_words")
    return {
        "words": n.cast("double"),
        "word_length": share(F.col("word_chars"), n),
        "symbols": share(F.col("n_symbols"), n),
        "marks": share(F.col("n_marks"), n),
        "upper": share(F.col("n_upper"), F.col("word_chars")),
        "duplicate_lines": share(F.col("n_dup_lines"), n),
        "repeated": share(F.col("n_repeat_words"), n),
        "variety": share(F.col("n_distinct_words"), n),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"f_{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Sequence[Condition]) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def learn_rules(labelled: DataFrame, label: str = "quality", key: str = "doc_id") -> list[Rule]:
    """Ordered rules that reject rows of label 0.

    `labelled` has the columns `f_<feature>`. Thresholds are quantiles. Rows are reduced to counts of cells (the
    features cut at the thresholds), and each step reads the counts of every
    threshold in one aggregation. A rule grows by information gain on two thirds of the
    rows, by hash of the key, and is cut back on the others to the prefix with the best
    balance; covering stops where the next rule's precision there is too low. Ties go to
    the first feature and the lowest threshold. No labels, no rules.
    """
    names = list(features())
    known = labelled.filter(F.col(label).isNotNull())
    steps = [(i + 1) / BINS for i in range(BINS - 1)]
    # finer at both ends, where rare kinds of text lie
    steps = sorted({*steps, 0.005, 0.01, 0.02, 0.98, 0.99, 0.995})
    found = known.agg(*[F.percentile_approx(f"f_{n}", steps, 10_000).alias(n) for n in names]).first()
    if found[0] is None:
        return []
    cuts = {n: sorted(set(found[n])) for n in names}

    def cell(name: str) -> Column:
        # the upper edge of the value's bin; values above all cuts fall into an open bin
        edges = F.array(*[F.lit(float(c)) for c in cuts[name]])
        return F.coalesce(F.get(F.filter(edges, lambda e: F.col(f"f_{name}") <= e), F.lit(0)), F.lit(float("inf")))

    pruning = F.pmod(F.xxhash64(key), F.lit(3)) == 0
    bad = (F.col(label) == 0).cast("bigint")
    cells = known.select(pruning.alias("_pruning"), bad.alias("_bad"), *[cell(n).alias(f"f_{n}") for n in names])
    cells = cells.groupBy("_pruning", *[f"f_{n}" for n in names]).agg(
        F.sum("_bad").alias("_bad"), F.sum(1 - F.col("_bad")).alias("_good")
    )
    cells = stage(cells, "cells")
    rules: list[Rule] = []

    def uncovered() -> DataFrame:
        return cells.filter(~reduce(lambda a, b: a | b, (_holds(r) for r in rules), F.lit(False)))

    def counts(rows: DataFrame) -> tuple[int, int]:
        bad_rows, good_rows = rows.agg(F.sum("_bad"), F.sum("_good")).first()
        return bad_rows or 0, good_rows or 0

    def conditions(rows: DataFrame) -> list[tuple[Condition, int, int]]:
        """Every condition with its bad and good rows, from one aggregation."""
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"f_{n}").alias("v")) for n in names])).alias("p")
        table_of = rows.select("_bad", "_good", pairs).groupBy("p.n", "p.v").agg(F.sum("_bad"), F.sum("_good")).collect()
        out = []
        for name in names:
            bins = sorted((v, b, g) for n, v, b, g in table_of if n == name)
            all_bad, all_good = sum(b for _, b, _ in bins), sum(g for _, _, g in bins)
            low_bad = low_good = 0
            for value, b, g in bins[:-1]:
                low_bad, low_good = low_bad + b, low_good + g
                out.append((Condition(name, False, value), low_bad, low_good))
                out.append((Condition(name, True, value), all_bad - low_bad, all_good - low_good))
        return out

    while len(rules) < MOST_RULES:
        left = uncovered()
        grown: list[Condition] = []
        bad_rows, good_rows = counts(left.filter(~F.col("_pruning")))
        while bad_rows and good_rows and len(grown) < MOST_CONDITIONS:
            here = left.filter(~F.col("_pruning") & _holds(grown))
            before = log2(bad_rows / (bad_rows + good_rows))
            options = [(b * (log2(b / (b + g)) - before), c, b, g) for c, b, g in conditions(here) if b >= LEAST_ROWS]
            if not options:
                break
            gain, chosen, b, g = max(options, key=lambda o: o[0])
            if gain <= 0:
                break
            grown.append(chosen)
            bad_rows, good_rows = b, g
        if not grown:
            break
        trial = left.filter("_pruning")
        kept = [(counts(trial.filter(_holds(grown[: i + 1]))), i + 1) for i in range(len(grown))]

        def precision(found: tuple[int, int]) -> float:
            # corrected, so that a prefix with a handful of rows does not win
            return (found[0] + 0.5) / (sum(found) + 1)

        best, length = max(kept, key=lambda k: (precision(k[0]), -k[1]))
        if precision(best) < LEAST_PRECISION:
            break
        rules.append(tuple(grown[:length]))
    return rules


def decision(rules: Sequence[Rule]) -> Column:
    """The ordered list as one conditional expression: number of the rule that fires, 0 for none."""
    fires = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        fires = F.when(_holds(rule), number).otherwise(fires)
    return fires


def judge(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Statistics of every row, `base_failed`, the `rule` that rejects it (0: none) and `kept`.

    A NULL or empty text fails the base rule. Labels of unknown documents are left out, a document
    with several labels counts once for each. Without labels only the base rule rejects.
    Columns of `df` other than key and text play no part.
    """
    counted = stage(text_statistics(df.select(key, text), text).drop(text), "statistics")
    shown = counted.withColumns({f"f_{n}": c for n, c in features().items()})
    marks = labels.select(F.col(key).alias("_key"), F.col("quality").alias("quality"))
    rules = learn_rules(shown.join(marks, F.col(key) == F.col("_key")), "quality", key)
    judged = shown.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents by the base rule and the learned list."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
