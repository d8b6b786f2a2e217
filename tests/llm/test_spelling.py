"""Spelling variants against plain Python."""

import zlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import spelling
from tradeloom.llm.common import table

SF = "/root/testdata/sf0.001"
FIXTURE = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def slow_counts(docs):
    found = Counter()
    letters = {chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]}
    for name, text in docs:
        run = ""
        for c in (text or "") + " ":
            if c in letters:
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 5:
                    found[run] += 1
            run = ""
    return {w: n for w, n in found.items() if n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_groups(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        ((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()), key=repr
    )


def ours(spark, counts, symbols=spelling.SYMBOLS):
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return sorted((tuple(r) for r in spelling.variant_groups(df, symbols).collect()), key=repr)


def test_counts_of_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    expected = slow_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == expected and len(expected) > 1000


def test_query_equals_all_pairs_of_words(spark):
    """The whole query on a fixture of real words, copies and variants among them."""
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").limit(40).collect()]
    expected = slow_groups(slow_counts(docs))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = sorted((tuple(r) for r in spelling.variant_groups(spelling.word_counts(df)).collect()), key=repr)
    assert found == expected and sum(f is not None for _, f, *_ in expected) > 10


WORDS = st.dictionaries(st.text("abé÷z", min_size=1, max_size=6), st.integers(1, 20), min_size=1, max_size=60)


@pytest.mark.parametrize("symbols", [1, 2, 8])
@FIXTURE
@given(WORDS)
def test_groups_of_words_over_few_letters(spark, symbols, counts):
    """Repeated letters, all edits, ties; with one symbol every word of a length meets every other."""
    assert ours(spark, counts, symbols) == slow_groups(counts)


def test_long_words_and_chains(spark):
    long = "ab" * 2000
    counts = {long: 3, long + "a": 6, long[:-1] + "x": 2, "a" * 64: 4, "a" * 65: 9, "a" * 66: 1}
    counts |= {"word": 1, "words": 2, "swords": 4, "swordes": 8, "swordies": 16, "lonely": 5}
    assert ours(spark, counts) == slow_groups(counts)
    assert dict((w, r) for w, _, r, *_ in ours(spark, counts))["word"] == "swordies"


def test_neighbourhoods_hold_every_edit():
    letters = [chr(c) for c in range(97, 123)]
    for word in ("letter", "aab", "zzzz", "q"):
        def keys_of(w):
            return {int(k) for _, hashes in spelling.neighbour_keys([w]) for k in hashes}

        def own(w):
            return int(spelling.reduced_keys([w])[0][0])

        edits = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters} - {word}
        edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        for other in edits:
            assert own(other) in keys_of(word) or own(word) in keys_of(other)


def test_nulls_empty_texts_and_other_columns(spark):
    rows = [(None, "Straße Straße Straße", 1), (1, None, 2), (2, "", 3), (3, "ÀÉÎÕÜ àéîõü", 4), (3, "ÀÉÎÕÜ ÀÉÎÕÜ x", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word int").withColumn("n", F.lit(1))
    expected = slow_counts([(r[0], r[1]) for r in rows])
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == expected == {"straße": 3, "ÀÉÎÕÜ": 3}
    empty = spelling.variant_groups(spelling.word_counts(df.filter("false")))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0
