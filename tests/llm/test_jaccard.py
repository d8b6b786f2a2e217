"""The Jaccard join against comparing all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradeloom.llm import jaccard
from tradeloom.llm.jaccard import Shingler, components, near_duplicates, op4_ngram_jaccard, prefix_size

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(1, len(words))))}


def brute(rows):
    """(key, size, component) of (key, text) rows, by all pairs with a common shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    for i, s in enumerate(sets):
        for j, common in Counter(j for g in s for j in lists[g] if j < i).items():
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[root(i)] = min(key, smallest.get(root(i), key))
    return sorted(((k, len(sets[i]), smallest.get(root(i))) for i, (k, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op4_ngram_jaccard(spark, SF)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, seed):
    """Copies with few to many changes, chains of copies, a passage that all share, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "THE", "é"]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 7, 12, 40, 120, 300]))
        for _ in range(rng.choice([1, 2, 30])):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0.01, 0.03, 0.06, 0.12]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.4:
                copy += passage
            if rng.random() < 0.3:
                base = copy
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", "\t "]).join(copy)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(near_duplicates(df)) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"x{i % 70_001}" for i in range(250_000))
    rows = [(5, None), (4, ""), (3, " \t"), (9, "one"), (8, "ONE"), (7, "a b c d"), (6, "a  b\nc d"), (None, "a b c d"), (None, "alone here"),
            (2, long), (1, long + " y"), (2, "a b c d"), (2, "a b c d"), (10, "a b c d e f"), (11, "a b c d e f")]
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id bigint, text string, node string, n int")
    assert found(near_duplicates(df)) == sorted(
        [(k, n, k if not n else c) for k, n, c in brute(rows)], key=str
    )
    assert found(near_duplicates(df.limit(0))) == []


def test_hashes_are_those_of_whole_shingles():
    rng = random.Random(4)
    words = [rng.choice(["a", "bb", "é", "ccc"]) for _ in range(3000)]
    shingler = Shingler()
    assert len(shingler.hashes(" ".join(words))) == len({tuple(words[i : i + 5]) for i in range(2996)})
    # the place in the text and other shingles do not matter
    alone = {int(h) for i in range(50) for h in shingler.hashes("\n".join(words[i : i + 5]))}
    assert alone <= {int(h) for h in shingler.hashes(" ".join(words))}
    assert np.array_equal(shingler.hashes("A b C"), shingler.hashes(" a  B c"))


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(str(i % 997) for i in range(5000))
    whole = Shingler().hashes(text)
    monkeypatch.setattr(jaccard, "WORDS_AT_ONCE", 100)
    assert np.array_equal(Shingler().hashes(text), whole)


def test_prefix_size():
    for n in range(1, 200):
        least = next(k for k in range(n + 1) if 4 * k >= 3 * n)  # overlap with any linked set
        assert prefix_size(n) == n - least + 1


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(100, 130)] + [(7, 5), (5, 9)]
    labels = components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    assert {r.node: r.label for r in labels} == {**{i: 100 for i in range(100, 131)}, 5: 5, 7: 5, 9: 5}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 500, rng.integers(1, 400)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        bits = np.bitwise_count(jaccard.parity_signature(a).view(np.uint64) ^ jaccard.parity_signature(b).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_links_of_every_row_are_counted(spark):
    """Groups of near copies with exact copies among them, far copies, a shared passage, and texts without words."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = [None, "", "  ", "one two", "one two"]
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.randint(30, 200))
        for k in range(25):
            words = list(base)
            for _ in range(k % 8):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts += [" ".join(words)] * rng.choice([1, 1, 3])
    texts += [" ".join(["a", "b", "c", "d", "e", "f", "g", *rng.choices(vocabulary, k=8)]) for _ in range(30)]
    rows = list(enumerate(texts))
    sets = [shingles(t) for t in texts]
    expected = {
        i: sum(j != i and bool(s & t) and 100 * len(s & t) >= 75 * len(s | t) for j, t in enumerate(sets)) for i, s in enumerate(sets)
    }
    df = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), count_links=True)
    assert found(df) == brute(rows)
    assert {r.doc_id: r.n_links for r in df.collect()} == expected
    assert max(expected.values()) > 20 and df.columns == ["doc_id", "n_shingles", "component_id", "n_links"]


def test_texts_are_hashed_twice_and_shuffles_do_not_pile_up(spark, tmp_path, monkeypatch):
    """One pass gives sizes and lists, one the whole sets; a stored frame leaves no shuffle behind."""
    passes, kept, of = [], [], jaccard._batches

    def counted(df, text, columns, row, schema):
        passes.append(row.__name__)
        return of(df, text, columns, row, schema)

    def settled(df, label):
        kept.append(label)
        return common_settled(df, label)

    common_settled = jaccard.settled
    monkeypatch.setattr(jaccard, "_batches", counted)
    monkeypatch.setattr(jaccard, "settled", settled)
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, None), (None, "x"), (3, "other words than these")]
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert passes == ["_listed", "whole"]
    assert {"hashed", "listed", "index", "shingles", "stars", "split"} <= set(kept)


def test_slices_hold_every_hash_once():
    hashes = np.unique(np.random.default_rng(3).integers(0, 1 << 64, 4000, dtype=np.uint64, endpoint=False))
    for part in (1.0, jaccard.COUNTED_PART):
        slices = jaccard._sliced(hashes, part)
        assert len(slices) == jaccard.SLICES and (np.concatenate(slices) == hashes.view(np.int64)).all()
        first = slices[0].view(np.uint64)
        assert 0 < len(first) < len(hashes) * part * 1.5 / jaccard.SLICES
    assert [len(s) for s in jaccard._sliced(hashes[:0])] == [0] * jaccard.SLICES


def test_wide_rows_are_shuffled_a_slice_at_a_time(spark, monkeypatch):
    """Lists, overlaps and remaining pairs are stored by slices; only entries of lists of several sets are kept."""
    kept, of = [], jaccard.settled

    def settled(df, label):
        stored = of(df, label)
        kept.append((label, stored.count()))
        return stored

    monkeypatch.setattr(jaccard, "settled", settled)
    alone = [(i, " ".join(f"{i}-{k}" for k in range(40))) for i in range(20)]
    base = [f"w{k}" for k in range(60)]
    near = [(100 + i, " ".join([*base[:30], f"x{i}", *base[30:]])) for i in range(3)]
    rows = [*alone, *near, *[(200 + k, text) for k in range(3) for _, text in near]]
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))) == brute(rows)
    stored = Counter(label for label, _ in kept)
    assert stored["listed"] == jaccard.SLICES and stored["overlaps"] == 3 * jaccard.SLICES
    assert stored["pairs"] == 3 + jaccard.SLICES  # of three comparisons, and the remaining ones by slices
    shared = sum(n for label, n in kept if label == "listed")
    assert 0 < shared <= 3 * 58  # no entry of a set alone, and copies once


def test_copies_of_a_task_are_listed_once_and_lie_in_any_task(spark):
    schema = "node bigint, other bigint, n bigint, counted bigint, " + ", ".join(f"{s} array<bigint>" for s in jaccard._columns_of_slices("tokens"))
    text = " ".join(f"w{k}" for k in range(80))
    df = spark.createDataFrame([(i, text) for i in range(12)], "doc_id long, text string").coalesce(1)
    rows = jaccard._batches(df, "text", ["doc_id"], jaccard._listed, schema).collect()
    assert len(rows) == 12 and {r.n for r in rows} == {76}
    assert sum(any(r[s] for s in jaccard._columns_of_slices("tokens")) for r in rows) == 1
    copies = [(i, text if i % 3 else text.replace("w40", "x")) for i in range(30)]
    assert found(near_duplicates(spark.createDataFrame(copies, "doc_id long, text string").repartition(7), count_links=False)) == brute(copies)
