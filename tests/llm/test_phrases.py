"""Collocations against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import phrases

FIXTURE = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def slow(docs, fewest, longest=5, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    kept = {p: a for p, a in f.items() if a >= fewest and len(p) > 2}
    out = []
    for (lang, *words), a in kept.items():
        longer = [q for q in kept if q[0] == lang and len(q) - 1 > len(words) and 100 * kept[q] >= 100 * a]
        if any(list(q[s : s + len(words)]) == words for q in longer for s in range(1, len(q) - len(words) + 1)):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]], n[lang]))
    ranked = []
    for lang in sorted({r[0] for r in out}):
        for rank, (_, score, a, phrase, left, right, total) in enumerate(sorted(r for r in out if r[0] == lang)[:top], 1):
            ranked.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return ranked


def ours(df, fewest, longest=5, top=2000):
    return sorted(tuple(r) for r in phrases.collocations(phrases.frequent_phrases(df, fewest=fewest, longest=longest), top).collect())


WORDS = st.lists(st.sampled_from(["a", "B", "b", "é", "a,", ".", "b\tc", "x\x0b", " ", "a b a b"]), max_size=25).map(" ".join)
DOCS = st.lists(st.tuples(st.sampled_from(["en", "de", None, "und"]), st.one_of(st.none(), WORDS)), min_size=1, max_size=8)


@FIXTURE
@given(DOCS, st.integers(2, 4))
def test_collocations_of_few_words(spark, docs, fewest):
    df = spark.createDataFrame(docs, "lang string, text string")
    assert ours(df, fewest) == slow(docs, fewest)


def test_passages_repeats_and_a_very_common_pair(spark):
    docs = [("en", "the very same passage of eight words here. " + "of the " * (n % 7)) for n in range(30)]
    docs += [("en", "New York, new york; NEW YORK! new  york\tis " + "of the " * 40), ("de", "x " * 50), ("de", "")]
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({"at": F.lit(1), "word": F.lit("w"), "id": F.lit(2)})
    found = ours(df, 3)
    assert found == slow(docs, 3) and len(found) > 10
    assert ours(df, 3, top=2) == slow(docs, 3, top=2)
    assert ours(df.filter("false"), 3) == []


@pytest.mark.parametrize("at_once", [7, 40, 1 << 20])
def test_a_text_is_read_in_parts_without_losing_or_repeating_phrases(monkeypatch, at_once):
    """Every phrase of up to five tokens lies in one chunk as new, whatever the chunks' size."""
    text = "one two three, " * 40 + "w" * 50 + " " + "four five six seven eight nine " * 30
    whole = phrases.TOKEN.findall(text)
    monkeypatch.setattr(phrases, "TEXT_AT_ONCE", at_once)
    monkeypatch.setattr(phrases, "TOKENS_AT_ONCE", at_once)
    assert [t for part in phrases.tokens_of(text) for t in part] == whole
    monkeypatch.setattr(phrases, "TOKENS_HELD", 2 * at_once)
    texts = [("x", whole), ("y", whole), ("x", ["z", "z"])]
    runs = [(lang, c.seen, c.last(len(c.tokens))) for lang, c in phrases.chunks_of(iter([("x", text), ("y", text), ("y", ""), ("x", "z z")]), 4)]
    assert (len(runs) > 2) == (at_once < 1000)
    for k in range(1, 6):
        new = Counter((lang, *tokens[at : at + k]) for lang, seen, tokens in runs for at in range(len(tokens) - k + 1) if at > seen - k)
        expected = Counter((lang, *tokens[at : at + k]) for lang, tokens in texts for at in range(len(tokens) - k + 1))
        marks = set(phrases.SEPARATORS)
        assert {p: c for p, c in new.items() if not set(p[1:]) & marks} == {p: c for p, c in expected.items() if not set(p[1:]) & marks}


def test_collocations_over_many_chunks(spark):
    """The workers read the limit from the closure's module, so small chunks come from many partitions and long texts."""
    docs = [("en", "a b c d e, f g " * 30 + "a b " * (n % 3)) for n in range(12)] + [(None, "a b c. " * 50)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(6)
    found = ours(df, 5)
    assert found == slow(docs, 5) and len(found) > 5


def test_merging_counts_only_what_is_new():
    at, phrase = np.arange(7, dtype=np.int32), np.array([3, 4, 3, 4, 3, 4, 3])
    begin, candidate, a, b, counts = phrases.merged(at, phrase, 4, 2)
    assert begin.tolist() == [0, 1, 2, 3, 4, 5] and dict(zip(zip(a.tolist(), b.tolist()), counts.tolist())) == {(3, 4): 1, (4, 3): 2}
    assert [v.tolist() for v in phrases.merged(at[:0], phrase[:0], 0, 2)] == [[]] * 5


def test_scores_beyond_64_bits(spark):
    row = [("en", ["a", "b"], 4 * 10**12, [5 * 10**12], [6 * 10**12], False, 9 * 10**13)]
    df = spark.createDataFrame(row, "lang string, words array<string>, f bigint, prefixes array<bigint>, suffixes array<bigint>, covered boolean, n bigint")
    assert phrases.collocations(df).first().score == 1000 * 4 * 10**12 * 9 * 10**13 // (30 * 10**24)


def test_numbers_are_packed_by_byte(spark):
    """Bytes of the same weight lie together: they compress to far less than the numbers as they are."""
    numbers = np.exp(np.random.default_rng(1).random(50_000) * np.log(60_000)).astype(np.int32)
    numbers[:3] = -1, 2**31 - 2, 0
    assert phrases.unpacked(phrases.packed(numbers)).tolist() == numbers.tolist()
    assert phrases.unpacked(phrases.packed(numbers[:0])).tolist() == []
    size = lambda data: len(pa.compress(data, "lz4", asbytes=True))
    assert size(phrases.packed(numbers)) < 0.75 * size(numbers.tobytes())
    df = spark.createDataFrame([("en", "a b, " * 400)], "lang string, text string")
    (chunk,) = phrases.token_chunks(df).collect()
    assert phrases.unpacked(chunk.tokens).tolist() == [0, 1, -1] * 400 + [-1]
