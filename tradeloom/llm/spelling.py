"""Groups of spelling variants, by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one inserted, deleted or replaced
letter differ by at most that in their reduced words, so that the one-edit neighbourhood of one reduced
word holds the other: the neighbourhoods, which are far smaller than those over all letters, are generated
in full, joined with the reduced vocabulary, and every pair is verified on the original
strings. An unordered pair is generated once: insertions are met as deletions from the longer
word, and replacements from the word with the lower symbol.

A reduced word is known by a polynomial hash, of which every neighbour costs one addition; a clash of
hashes only adds a pair to verify. Nothing is capped. Words longer than `LONG` letters travel by number and are
looked up for the pairs found, so that a long word is not copied for each of its neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import map_batches, stage, table

# Fixed by the contract: what a word is, which runs are misspelt, and which words count.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
MISSPELT = 97
SHORTEST = 5
FEWEST = 3

SYMBOLS = 8
LONG = 64
# Distinct words that a task adds up before it hands them on.
HELD_WORDS = 200_000
# Keys that a task hands on at once.
KEYS_AT_ONCE = 500_000
_BASE = 0x9E3779B97F4A7C15


# --- words and how often they occur ---


def spelt_words(doc_id: str, text: str) -> Counter:
    """The words of a text, with the misspelling that the id and the word decide."""
    words: Counter = Counter()
    seed = zlib.crc32(f"{doc_id}:".encode())
    # bytes.lower changes A to Z alone
    for run, count in Counter(RUN.findall(text.encode("utf-8", "replace").lower().decode())).items():
        at = zlib.crc32(run.encode(), seed)
        if at % MISSPELT == 0:
            gone = at % len(run)
            run = run[:gone] + run[gone + 1 :]
        if len(run) >= SHORTEST:
            words[run] += count
    return words


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`word, n` over the whole texts of all documents; a NULL text has none, a NULL id counts as empty.

    Tasks add up what they read before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())}
            )

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(spelt_words(name, value))
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    read = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.coalesce(text, F.lit("")).alias("text")
    )
    counted = map_batches(read, count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


# --- neighbourhoods ---


def symbol(code: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol, from 1, to which a letter is hashed."""
    return (code.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(symbols) + np.uint64(1)


def _powers(length: int) -> np.ndarray:
    """Powers of the hash's base, modulo 2^64."""
    return np.concatenate([np.ones(1, np.uint64), np.full(length, _BASE, np.uint64)]).cumprod(dtype=np.uint64)


def reduced_keys(words: list[str], symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each reduced word, and its symbols; all words have one length."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)
    reduced = symbol(codes, symbols)
    return (reduced * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64), reduced


def neighbour_keys(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words, hashes) of the neighbours of words of one length, for each kind of edit.

    The reduced words themselves, then every replacement by a higher symbol and every deletion.
    Of equal symbols in a row only the first is deleted, as the others give the same.
    """
    own, reduced = reduced_keys(words, symbols)
    length = reduced.shape[1]
    everyone = np.arange(len(words))
    yield everyone, own
    powers = _powers(length)
    for at in range(length):
        for up in range(1, symbols):
            able = reduced[:, at] + np.uint64(up) <= symbols
            yield everyone[able], own[able] + np.uint64(up) * powers[at : at + 1]
    before = np.zeros(len(words), np.uint64)
    after = own
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    for at in range(length):
        term = reduced[:, at] * powers[at]
        after = after - term
        first = np.ones(len(words), bool) if at == 0 else reduced[:, at] != reduced[:, at - 1]
        yield everyone[first], (before + after * inverse)[first]
        before = before + term


def _batches_of_one_length(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    lengths = np.array([len(w) for w in batch.column("word").to_pylist()], dtype=np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        at_once = max(1, KEYS_AT_ONCE // int(length * SYMBOLS))
        for start in range(0, len(rows), at_once):
            yield rows[start : start + at_once]


def _keyed(vocabulary: DataFrame, symbols: int, whole: bool, carried: list[str]) -> DataFrame:
    """Keys of the reduced words, or with `whole` of all their neighbours too: `key, kind, id, n` and the columns `carried`.

    The kind is 0 for the reduced word itself.
    """

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _batches_of_one_length(batch):
                part = batch.take(pa.array(rows))
                words = part.column("word").to_pylist()
                part = part.select(["id", "n", *carried])
                keys = neighbour_keys(words, symbols) if whole else [(np.arange(len(words)), reduced_keys(words, symbols)[0])]
                held: list[tuple[np.ndarray, np.ndarray, int]] = []
                size = 0
                for kind, (places, hashes) in enumerate(keys):
                    held.append((places, hashes, min(kind, 1)))
                    size += len(places)
                    if size >= KEYS_AT_ONCE:
                        yield _rows_of(part, held)
                        held, size = [], 0
                if held:
                    yield _rows_of(part, held)

    columns = "".join(f", {c} string" for c in carried)
    return map_batches(vocabulary.select("id", "n", "word"), generate, f"key bigint, kind int, id bigint, n bigint{columns}")


def _rows_of(part: pa.RecordBatch, held: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    places = np.concatenate([p for p, _, _ in held])
    keys = np.concatenate([k for _, k, _ in held]).view(np.int64)
    kinds = np.concatenate([np.full(len(p), kind, np.int32) for p, _, kind in held])
    taken = part.take(pa.array(places))
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(kinds), *taken.columns], ["key", "kind", *part.schema.names])


def near_pairs(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Every unordered pair of words one edit apart, once: `id, n, word, other_id, other_n, other`.

    `vocabulary` is a stored frame of distinct words: id, word, n. Pairs with a word of more than `LONG` letters,
    of which both have at least `LONG`, are met by number; the others carry their words.
    """
    letters = F.length("word")
    one_edit = F.levenshtein("word", "other", 1) == 1
    short = _met(vocabulary.filter(letters <= LONG), symbols, ["word"]).filter(one_edit)
    by_number = vocabulary.filter(letters >= LONG).select("id", "word")
    long = (
        _met(vocabulary.filter(letters >= LONG), symbols, [])
        .join(by_number, "id")
        .join(by_number.select(F.col("id").alias("other_id"), F.col("word").alias("other")), "other_id")
        .filter((F.greatest(letters, F.length("other")) > LONG) & one_edit)
    )
    return short.unionByName(long)


def _met(vocabulary: DataFrame, symbols: int, carried: list[str]) -> DataFrame:
    """Pairs of words of which one's neighbourhood holds the other, with the columns `carried` of both."""
    names = {"id": "other_id", "n": "other_n", "word": "other"}
    reduced = _keyed(vocabulary, symbols, False, carried).drop("kind").withColumnsRenamed(names)
    met = _keyed(vocabulary, symbols, True, carried).join(reduced, "key")
    return met.filter((F.col("kind") == 1) | (F.col("id") < F.col("other_id"))).drop("key", "kind")


# --- groups ---


def variant_groups(words: DataFrame, symbols: int = SYMBOLS, ratio: int = 2) -> DataFrame:
    """The form and the root of every word: `word, form, root, n, n_near, form_n`.

    `words` has distinct words with their counts (`word, n`); NULL words are left out. Near words are one inserted,
    deleted or replaced letter apart. A word's form is its most frequent near word (of equals the first in the order
    of code points), if that is `ratio` times as frequent as the word; its root is the last form of the chain
    that starts with it, or itself. Chains end, as forms grow in frequency.
    """
    numbered = words.filter(F.col("word").isNotNull()).select("word", "n").withColumn("id", F.monotonically_increasing_id())
    vocabulary = stage(numbered.select("id", "n", "word"), "vocabulary")
    both = near_pairs(vocabulary, symbols).select(
        F.inline(
            F.array(
                F.struct(F.col("id").alias("id"), (-F.col("other_n")).alias("down"), F.col("other").alias("near"), F.col("other_id").alias("near_id")),
                F.struct(F.col("other_id").alias("id"), (-F.col("n")).alias("down"), F.col("word").alias("near"), F.col("id").alias("near_id")),
            )
        )
    )
    nearest = both.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct("down", "near", "near_id")).alias("best"))
    often = -F.col("best.down") >= ratio * F.col("n")
    found = vocabulary.join(nearest, "id", "left").select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"),
        F.when(often, F.col("best.near_id")).alias("form_id"),
        F.when(often, -F.col("best.down")).alias("form_n"),
    )
    found = stage(found, "forms")
    roots = _roots(found.select("id", "form_id")).select("id", "root_id")
    names = vocabulary.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    rooted = found.join(roots.join(names, "root_id").select("id", "root"), "id", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """The last form of every word that has one. Each round doubles the length of the steps."""
    steps = stage(forms.filter(F.col("form_id").isNotNull()).select("id", F.col("form_id").alias("root_id")), "steps")
    while True:
        further = steps.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        moved = steps.join(further, "root_id", "left").select(
            "id", F.coalesce("next_id", "root_id").alias("root_id"), F.col("next_id").isNotNull().alias("moved")
        )
        steps = stage(moved, "steps")
        if steps.filter("moved").isEmpty():
            return steps


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants among the words of all documents."""
    return variant_groups(word_counts(table(spark, sf_dir, "documents")))
