"""Sampled segmentations against listing them all, and exact round trips."""

from collections import Counter
from itertools import product
from math import exp, log
from pathlib import Path

import numpy as np
import pytest
import sentencepiece

from tradeloom.llm import segment
from tradeloom.llm.segment import MODEL, Pieces, Sampler, decode, encode, log_inclusion, op10_sentencepiece, prepare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pieces():
    return Pieces(Path(MODEL).read_bytes())


def all_segmentations(pieces, text):
    """Ids to log probability, by trying every way of cutting."""
    known = {b: i for i, b in enumerate(pieces.bytes) if b and i not in set(pieces.byte_ids)}
    whole = " " + text

    def ways(at):
        if at == len(whole):
            return [((), 0.0)]
        out = []
        for end in range(at + 1, min(len(whole), at + pieces.longest) + 1):
            part = whole[at:end].encode()
            if part in known:
                out += [((known[part], *ids), w + pieces.weight[known[part]]) for ids, w in ways(end)]
            elif end == at + 1:
                data = tuple(pieces.byte_ids[b] for b in part)
                out += [((*data, *ids), w + len(data) * pieces.byte_weight) for ids, w in ways(end)]
        return out

    found = ways(0)
    total = np.logaddexp.reduce([w for _, w in found])
    return {ids: w - total for ids, w in found}


@pytest.mark.parametrize("text", ["the", "a b", "hé\nx", "in to", "日x"])
def test_samples_follow_their_chances(pieces, text):
    """First and second samples are those of drawing without replacement."""
    expected = {ids: exp(w) for ids, w in all_segmentations(pieces, text).items()}
    assert sum(expected.values()) == pytest.approx(1.0)
    draws, sampler = 6000, Sampler(pieces)
    firsts, pairs = Counter(), Counter()
    for rows in sampler.batch([text] * draws, list(range(draws)), 2):
        ids = [tuple(r[0].tolist()) for r in rows]
        assert len(set(ids)) == len(ids) == min(2, len(expected))
        for i, row in zip(ids, rows):
            assert row[1] == pytest.approx(log(expected[i]), abs=1e-9)
        firsts[ids[0]] += 1
        pairs[tuple(ids)] += 1
    for ids, p in expected.items():
        assert firsts[ids] == pytest.approx(draws * p, abs=5 * (draws * p * (1 - p)) ** 0.5 + 1)
    for a, b in product(expected, repeat=2):
        if a != b:
            p = expected[a] * expected[b] / (1 - expected[a])
            assert pairs[a, b] == pytest.approx(draws * p, abs=5 * (draws * p * (1 - p)) ** 0.5 + 1)


def test_more_samples_than_segmentations(pieces):
    expected = all_segmentations(pieces, "an")
    (rows,) = Sampler(pieces).batch(["an"], [4], 50)
    assert {tuple(r[0].tolist()) for r in rows} == set(expected)
    assert all(r[3] == 0.0 for r in rows)  # there is nothing else, so all are sure to be in
    assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)


def test_inclusion_scores_make_sums_unbiased(pieces):
    """Chances divided by inclusion scores add up to one on average."""
    sums = []
    for rows in Sampler(pieces).batch(["the in"] * 4000, list(range(4000)), 3):
        sums.append(sum(exp(r[1] - r[3]) for r in rows))
    assert np.mean(sums) == pytest.approx(1.0, abs=5 * np.std(sums) / len(sums) ** 0.5)


def test_deep_parts_are_looked_at_only_if_needed(pieces, monkeypatch):
    text = "then the thing and what not in the end " * 4
    usual = Sampler(pieces).batch([text] * 50, list(range(50)), 4)
    monkeypatch.setattr(segment, "DEPTH", 1e9)
    whole = Sampler(pieces).batch([text] * 50, list(range(50)), 4)
    assert [[(r[0].tolist(), r[2], r[3]) for r in rows] for rows in usual] == [[(r[0].tolist(), r[2], r[3]) for r in rows] for rows in whole]


def test_documents_round_trip(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op10_sentencepiece(spark, SF)
    rows = found.collect()
    assert Counter(r.doc_id for r in rows) == {i: 2 for i in texts}
    assert all(r.round_trip and r.n_pieces == len(r.ids) and r.log_inclusion <= 0 for r in rows)
    assert all(a.ids != b.ids for a, b in zip(*(sorted((r for r in rows if r["rank"] == k), key=lambda r: r.doc_id) for k in (1, 2))))
    assert {(r.doc_id, r.text) for r in decode(found).collect()} == set(texts.items())
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(processor.decode(r.ids) == texts[r.doc_id] for r in rows[:200])


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, " "), (4, "  a  "), (5, "a▁b\n\n\tc"), (6, "日本語 😀 \u0000 ｆｉ"), (7, "w" * 100_000), (8, "same"), (8, "same"), (9, "the cat " * 20_000)]
    df = spark.createDataFrame([(i, t, 1.0, "r") for i, t in rows], "doc_id bigint, text string, score double, rank string")
    found = encode(df).collect()
    assert all(r.round_trip for r in found)
    assert {(r.doc_id, r.text) for r in decode(encode(df)).collect()} == {(i, t or "") for i, t in rows}
    by_id = Counter(r.doc_id for r in found)
    assert by_id[1] == by_id[2] == 1 and by_id[8] == 4 and by_id[7] == 2
    same = sorted((r["rank"], r.ids) for r in found if r.doc_id == 8)
    assert same[0] == same[1] and same[2] == same[3]
    assert encode(df.limit(0)).collect() == []
    assert decode(spark.createDataFrame([(None,)], "ids array<int>")).collect()[0].text is None


def test_chunks_hold_all_of_the_text():
    for text in ["", "a", " a  b\n c", "\n\n", "x▁y"]:
        assert "".join(prepare(text)).replace("▁", " ").replace(segment.SPACE_SIGN, "▁") == (" " + text if text else "")


def test_spelling_joins_the_bytes_of_pieces(pieces):
    for ids in [[], [5], pieces.byte_ids[:4], list(range(len(pieces.bytes))) * 2]:
        assert pieces.spell(np.array(ids, dtype=np.int64)) == b"".join(pieces.bytes[i] for i in ids)


def test_log_inclusion():
    for x in (-50.0, -20.0, -1.0, 0.0, 3.0, 4.9, 6.0, np.inf):
        exact = 0.0 if x > 40 else log(-np.expm1(-exp(x)))
        assert log_inclusion(x) == pytest.approx(exact, abs=1e-9)


def test_forgotten_words_are_built_again(pieces, monkeypatch):
    texts = [f"word{i} other{i % 7} thing" for i in range(60)]
    usual = Sampler(pieces).batch(texts, list(range(60)), 2)
    monkeypatch.setattr(segment, "KEPT_EDGES", 50)
    monkeypatch.setattr(segment, "MOST_EDGES", 200)
    sampler = Sampler(pieces)
    found = [sampler.batch([t], [i], 2)[0] for i, t in enumerate(texts)]
    assert [[(r[0].tolist(), r[1:]) for r in rows] for rows in found] == [[(r[0].tolist(), r[1:]) for r in rows] for rows in usual]
    assert sampler.lattices.n_edges < 1000


def test_search_stops_where_no_piece_goes_on(pieces):
    """The table of a length has all beginnings of pieces, told apart, and no text leads further than its pieces do."""
    spelled = {pieces.bytes[i].decode().replace(" ", segment.SPACE): i for h, ids, _ in pieces.table for i in ids[ids >= 0].tolist()}
    assert len(spelled) == sum(int((ids >= 0).sum()) for _, ids, _ in pieces.table)
    for length in (1, 2, 5, pieces.longest):
        hashes, ids, longer = pieces.table[length]
        begins = {p[:length] for p in spelled if len(p) >= length}
        assert len(hashes) == len(begins) and (np.diff(hashes) > 0).all()
        assert longer.sum() == len({p[:length] for p in spelled if len(p) > length})
    assert not pieces.table[pieces.longest][2].any()


def test_words_are_cut_alike_by_both_ways():
    """Ordinary texts are cut without the pattern, with the same words."""
    odd = ["a", "a b", " a", "a ", "a\n", "\na", "a \n b", "a\n\nb c", "a  b", "\n", " ", "x\0y z", f"a{segment.SPACE}b c", "é ü\n", "a \n", "\n \n"]
    for text in odd:
        shown = text.replace(segment.SPACE, segment.SPACE_SIGN)
        assert segment.prepare(text) == segment.CHUNKS.findall(segment.SPACE + shown.replace(" ", segment.SPACE)), repr(text)
        assert "".join(segment.prepare(text)) == segment.SPACE + shown.replace(" ", segment.SPACE)


def test_largest_of_each_group():
    rng = np.random.default_rng(3)
    groups = np.repeat([2, 5, 6, 9], [1, 40, 2, 300])
    values = rng.normal(size=len(groups))
    for wanted in (1, 2, 3):
        expected = [i for g in (2, 5, 6, 9) for i in sorted(np.flatnonzero(groups == g), key=lambda i: -values[i])[:wanted]]
        assert segment.Sampler._largest(values, groups, wanted).tolist() == sorted(expected)
    assert segment.Sampler._largest(np.array([1.0, 2.0, 2.0]), np.array([4, 4, 4]), 1).tolist() == [1, 2]
    assert len(segment.Sampler._largest(np.empty(0), np.empty(0, dtype=np.int64), 2)) == 0
