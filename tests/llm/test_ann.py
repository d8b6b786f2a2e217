"""Nearest neighbours against comparing all pairs, and the bounds that rule pairs out."""

import math

import duckdb
import numpy as np
import pytest

from tradeloom.llm.ann import OP1_SQL, inner_products, nearest, nearest_in_tile, op1_ann, tile_bounds, usable_vectors

SF = "/root/testdata/sf0.01"


def brute(rows, k, step):
    """(query, rank, id, score) over (id, vector) rows; every row but the query's own is a candidate."""
    out = []
    for n, (q, query) in enumerate(rows):
        if q % step:
            continue
        scores = []
        for m, (i, v) in enumerate(rows):
            if m != n and len(v) == len(query):
                total = 0.0
                for a, b in zip(query, v):
                    total += float(a) * float(b)
                scores.append((math.inf if math.isnan(total) else -total, i, total))
        out += [(q, r, i, s) for r, (_, i, s) in enumerate(sorted(scores, key=lambda e: e[:2])[:k], 1)]
    return sorted(out, key=repr)


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    expected = connection.execute(f"SELECT query_id, rank, vec_id, score FROM ({OP1_SQL})").fetchall()
    assert sorted(map(tuple, op1_ann(spark, SF).collect())) == sorted(expected)


@pytest.mark.parametrize("k, per_query_panel, per_panel", [(1, 3, 7), (5, 100, 20), (40, 10, 15)])
def test_tiles_of_all_sizes(spark, k, per_query_panel, per_panel):
    rng = np.random.default_rng(k)
    vectors = {int(i): [float(x) for x in rng.normal(size=6).astype(np.float32)] for i in rng.permutation(300)[:90]}
    twin = next(iter(vectors.values()))
    vectors |= {i: twin for i in range(1000, 1030)}  # equal vectors tie
    df = usable_vectors(spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<float>"))
    found = nearest(df, df.filter("vec_id % 4 = 0"), k, per_query_panel, per_panel).collect()
    assert sorted(map(tuple, found), key=repr) == brute(list(vectors.items()), k, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (40, [5.0, 5.0, 5.0]), (8, [-1.0, -2.0]), (8, [-1.0, -2.0]), (60, [1e-300, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, width string, panel int")
    vectors = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (7, [1.0] * 3), (40, [5.0] * 3), (8, [-1.0, -2.0]), (8, [-1.0, -2.0]), (60, [1e-300, 1.0])]
    usable = usable_vectors(df)
    found = nearest(usable, usable.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted(map(tuple, found), key=repr) == brute(vectors, 20, 20)
    assert nearest(usable.limit(0), usable.limit(0)).collect() == []
    alone = usable.filter("vec_id = 0")
    assert nearest(alone, alone).collect() == []


def test_repeated_ids_are_rows_of_their_own(spark, tmp_path):
    rows = [(20, [1.0, 2.0]), (1, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [0.0, 1.0]), (20, [1.0, 2.0]), (20, [-1.0, 0.5])]
    df = usable_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    for k in (2, 20):
        found = nearest(df, df.filter("vec_id % 20 = 0"), k).collect()
        assert sorted(map(tuple, found), key=repr) == brute(rows, k, 20)
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    in_sql = duckdb.sql(OP1_SQL.replace("FROM embeddings", f"FROM '{tmp_path}/embeddings.parquet/*.parquet'")).fetchall()
    assert sorted(in_sql, key=repr) == brute(rows, 20, 20)


def test_values_out_of_the_range_of_the_bounds(spark):
    ordinary = [(i, [float(i), 1.0]) for i in range(1, 30)]
    huge = [(100, [1e200, 1.0]), (120, [-1e200, 1e200]), (140, [1e308, 1e308]), (141, [1e308, -1e308]), (142, [1.7e308, -1.0])]
    tiny = [(160, [5e-324, 0.0]), (161, [-5e-324, 5e-324]), (180, [1e-170, 1e-170]), (181, [2e-170, 1e-170])]
    rows = ordinary + huge + tiny
    df = usable_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    for k, per_panel in ((5, 7), (60, 100)):
        found = nearest(df, df.filter("vec_id % 20 = 0"), k, 3, per_panel).collect()
        # by their texts, as some scores are no number
        assert sorted(map(repr, map(tuple, found))) == list(map(repr, brute(rows, k, 20)))


@pytest.mark.parametrize("width", [1, 64, 2500])
def test_bounds_hold(width):
    rng = np.random.default_rng(width)
    a, b = (rng.normal(size=(50, width)) * 10.0 ** rng.integers(-6, 6, (50, 1)) for _ in range(2))
    products, error = tile_bounds(a, b)
    exact = a @ b.T
    assert (np.abs(products - exact) <= error).all()
    # and they rule out most pairs of a larger tile
    if width == 64:
        products, error = tile_bounds(rng.normal(size=(20, 64)), rng.normal(size=(2000, 64)))
        floor = np.sort(products - error, axis=1)[:, -20]
        assert ((products + error) >= floor[:, None]).mean() < 0.05


def test_equal_vectors_score_alike_anywhere():
    rng = np.random.default_rng(0)
    query, vector = rng.normal(size=64), rng.normal(size=64)
    for n in (1, 7, 1000):
        assert (inner_products(np.tile(query, (n, 1)), np.tile(vector, (n, 1))) == inner_products(query[None], vector[None])).all()
    ids, scores, found = nearest_in_tile(np.array([99]), query[None], np.arange(9), np.arange(9), np.tile(vector, (9, 1)), 4)
    assert found.tolist() == [4]
    assert ids.tolist() == [[0, 1, 2, 3]] and len(set(scores[0])) == 1
