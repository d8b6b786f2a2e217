"""Sharding, quality rules and mixing against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from tradeloom.llm.mixing import MOST_COPIES, WEIGHTS, Flight, op9_mixing
from tradeloom.llm.rules import judge, op6_quality_rules, text_statistics
from tradeloom.llm.sharding import op5_sharding, shard_rows

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def jump(key: int, shards: int) -> int:
    """The published algorithm."""
    last, following, state = -1, 0, key % (1 << 64)
    while following < shards:
        last = following
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        following = int((last + 1) * ((1 << 31) / ((state >> 33) + 1)))
    return last


def test_shards_are_those_of_the_published_algorithm(spark, texts):
    rows = op5_sharding(spark, SF).collect()
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 40), jump(r.doc_id, 41))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(spark):
    rows = [(None, "x"), (-5, None), (2**63 - 1, ""), (7, "same"), (7, "same"), (7, "other")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for shards in (1, 2, 100):
        found = shard_rows(df, "doc_id", shards).collect()
        assert sorted(map(str, [(r.doc_id, r.text) for r in found])) == sorted(map(str, rows))
        for r in found:
            assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, shards), jump(r.doc_id or 0, shards + 1))
    assert shard_rows(df.limit(0), "doc_id").collect() == []
    with pytest.raises(ValueError):
        shard_rows(df, "doc_id", 0)


def statistics(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_and_base_rule(spark, texts):
    rows = op6_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = statistics(texts[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_learned_rules_agree_with_labels(spark):
    rows = {r.doc_id: r for r in op6_quality_rules(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [rows[r.doc_id].kept for r in labels if r.quality == 1 and not rows[r.doc_id].base_failed]
    bad = [rows[r.doc_id].kept for r in labels if r.quality == 0 and not rows[r.doc_id].base_failed]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.25 * len(bad)


def test_statistics_of_odd_texts(spark):
    odd = [None, "", " \t\n", "a", "a b a b a b", "x y x y", "a b c a b c", "l\n\nl\nl \n", "é " * 70_000, "w" * 200_000]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string")
    for r in text_statistics(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == statistics(odd[r.doc_id])


def test_rules_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a b c " * 9, "n"), (2, " ".join(map(str, range(99))), "m")], "doc_id bigint, text string, n_words string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.doc_id: r.kept for r in judge(df, none).collect()} == {1: False, 2: True}
    assert judge(df.limit(0), none).collect() == []


def waterfill(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(MOST_COPIES * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[t] for t in order if t not in full) for s in order if s not in full}
        above = {s for s in share if share[s] > MOST_COPIES * sizes[s]}
        if not above:
            return {s: share.get(s, MOST_COPIES * sizes[s]) for s in order}
        full |= above


def test_mix_meets_the_targets(spark, texts):
    rows = op9_mixing(spark, SF).collect()
    sizes = defaultdict(int)
    for r in texts.values():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets = waterfill(sizes)
    taken = defaultdict(int)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id].text or "")) and r.source == texts[r.doc_id].source
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-9)
        assert r.size == 0 or r.taken % r.size == 0 and r.taken <= MOST_COPIES * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, abs=max(40, 0.02 * target))
    assert sorted(map(tuple, op9_mixing(spark, SF).collect())) == sorted(map(tuple, rows))


def test_mix_of_odd_rows(spark, tmp_path):
    rows = [(None, None, None), (1, "", "a"), (2, "x y", None), (2, "x y", None), (3, "z " * 50_000, "b")]
    rows += [(4, "hot row", "c")] * 999 + [(10 + i, "w " * (i % 7), "c") for i in range(500)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCUMENTS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = op9_mixing(spark, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.source)) for r in found) == sorted(str((i, s)) for i, _, s in rows)
    for source in {s for _, _, s in rows}:
        mine = [r for r in found if r.source == source]
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, abs=max(8, 0.01 * mine[0].target)) or source == "b"
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op9_mixing(spark, f"{tmp_path}/empty").collect() == []


def test_flight_keeps_totals():
    import random

    draw = random.Random(5)
    units = [(float(draw.choice([1, 5, 5, 5, 300, draw.randrange(2000)])), draw.random()) for _ in range(3000)]
    flight = Flight("x")
    settled = [s for size, share in units for s in flight.add(size, share, (size,))]
    settled += [((u[0],), u[1]) for u in flight.open]
    assert len(settled) == len(units) and len(flight.open) <= 2
    assert sum(r[0] * p for r, p in settled) == pytest.approx(sum(s * p for s, p in units), rel=1e-6)
    assert sum(p for _, p in settled) == pytest.approx(sum(p for _, p in units), abs=1e-4)
