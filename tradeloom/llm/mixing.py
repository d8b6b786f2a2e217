"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import count_words, number_rows, stage, table

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
UNITS_PER_BLOCK = 4096
# Open units of a source that are settled together at the end, out of 2^LANDING choices.
LANDING = 16
SEED = 20240607

UNIT = "doc_id bigint, source string, size bigint, copies bigint, whole bigint, share double, block bigint, spot bigint"


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add each source's target: the total size by weight, no target above `most` times its size.

    `sources` has one row per source with `source` and `source_size`. Weights repeat over
    the sources in code point order, NULL last. What a full source leaves is shared out
    again by weight until no target is above its limit.
    """
    ordered = number_rows(sources, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    limits = stage(
        ordered.select("*", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("_limit")).drop("_place"),
        "limits",
    )
    total, all_weights = limits.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (float(total) / all_weights if total else 0.0), 0
    while total:
        above = F.lit(level) * F.col("weight") > F.col("_limit")
        taken, weights_left, now = limits.agg(
            F.sum(F.when(above, F.col("_limit"))), F.sum(F.when(~above, F.col("weight"))), F.count(F.when(above, 1))
        ).first()
        if now == full or not weights_left:
            break
        level, full = (float(total) - (taken or 0.0)) / weights_left, now
    return limits.withColumn("target", F.least(F.lit(level) * F.col("weight"), "_limit")).drop("_limit")


class Flight:
    """The flight phase over a stream of units, balancing their sizes and their number.

    Any three open units have a direction that keeps both totals, and moving along it
    settles at least one of them. At most `hold` units stay open.
    """

    def __init__(self, seed: str, hold: int = 2):
        self.draw = random.Random(seed)
        self.hold = max(hold, 2)
        self.open: list[list] = []  # [size, share, row]

    def add(self, size: float, share: float, row: tuple) -> Iterator[tuple[tuple, float]]:
        """Take a unit in; yields the units that became 0 or 1."""
        self.open.append([size, share, row])
        while len(self.open) > self.hold:
            yield from self._move()

    def _move(self) -> Iterator[tuple[tuple, float]]:
        trio, others = self.open[:3], self.open[3:]
        a, b, c = (unit[0] for unit in trio)
        way = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
        up = min(((1 - u[1]) if w > 0 else u[1]) / abs(w) for u, w in zip(trio, way) if w)
        down = min((u[1] if w > 0 else (1 - u[1])) / abs(w) for u, w in zip(trio, way) if w)
        step = up if self.draw.random() * (up + down) < down else -down
        rest = []
        for unit, w in zip(trio, way):
            unit[1] += step * w
            if unit[1] < 1e-9 or unit[1] > 1 - 1e-9:
                yield unit[2], float(unit[1] > 0.5)
            else:
                rest.append(unit)
        if len(rest) == len(trio):  # rounding kept all of them open: settle the nearest
            nearest = min(rest, key=lambda u: min(u[1], 1 - u[1]))
            rest.remove(nearest)
            yield nearest[2], float(nearest[1] > 0.5)
        self.open = rest + others

    def leave(self) -> Iterator[tuple[tuple, float]]:
        """The units that are still fractional, with their shares."""
        yield from ((unit[2], unit[1]) for unit in self.open)
        self.open = []

    def land(self) -> Iterator[tuple[tuple, float]]:
        """Settle the last units: one of the few choices with the least error in size and number."""
        if self.open:
            sizes, shares = np.array([u[0] for u in self.open]), np.array([u[1] for u in self.open])
            picks = (np.arange(1 << len(self.open))[:, None] >> np.arange(len(self.open))) & 1
            off = np.abs((picks - shares) @ sizes) + np.abs((picks - shares).sum(axis=1))
            best = np.argsort(off, kind="stable")[: len(self.open)]
            chosen = picks[best[self.draw.randrange(len(best))]]
            yield from ((unit[2], float(pick)) for unit, pick in zip(self.open, chosen))
            self.open = []


def _fly(group_by: tuple[str, ...], seed: int, landing: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, flight, columns = None, None, [c.split()[0] for c in UNIT.split(", ")]
        at = [columns.index(c) for c in group_by]
        size_at, share_at = columns.index("size"), columns.index("share")

        def rows(settled) -> list[tuple]:
            return [(*row[:share_at], share, *row[share_at + 1 :]) for row, share in settled]

        def end() -> list[tuple]:
            if flight is None:
                return []
            return rows(flight.land() if landing else flight.leave())

        for batch in batches:
            out: list[tuple] = []
            for row in batch[columns].astype(object).where(batch[columns].notna(), None).itertuples(index=False, name=None):
                key = tuple(row[i] for i in at)
                if flight is None or key != group:
                    out += end()
                    group, flight = key, Flight(f"{seed}|{landing}|{key}", LANDING)
                share = row[share_at]
                if share < 1e-9 or share > 1 - 1e-9:
                    out.append((*row[:share_at], float(share > 0.5), *row[share_at + 1 :]))
                else:
                    out += rows(flight.add(float(row[size_at]), share, row))
            yield _frame(out, columns)
        yield _frame(end(), columns)

    return run


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    kinds = {c.split()[0]: c.split()[1] for c in UNIT.split(", ")}
    return frame.astype({c: {"bigint": "Int64", "double": "float64", "string": "object"}[kinds[c]] for c in columns})


def mix(
    df: DataFrame,
    size: Column,
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
    units_per_block: int = UNITS_PER_BLOCK,
) -> DataFrame:
    """Copies to take of each row, so that every source's words come to its target.

    Returns `doc_id, source, size, source_size, target, taken_copies`, one row per input
    row. A source that is to give r times its size takes every row floor(r) times; the
    rest is each row's inclusion probability. The cube method settles these within blocks
    of about `units_per_block` units, keeping the block's totals of words and of rows; at
    most `LANDING` units of a block stay open. They go through a second flight per source, and
    the last `LANDING` are landed together with little error. Blocks follow from hashes of id and
    size, so the result depends on neither file layout nor cluster. Rows equal in id, source and
    size are one unit with several copies. NULL is a source of its own; a source without
    words has the target 0. An empty table gives an empty one.
    """
    sized = stage(
        df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(source_column).alias("source"), size.alias("size")),
        "sized",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    targets = stage(source_targets(sources, weights, most), "targets")
    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    known = units.join(targets, units["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # of all copies of a unit together; a unit of one row has at most one open share
    extra = (rate - F.floor(rate)) * F.col("copies")
    spot = F.xxhash64("doc_id", "size", F.lit(seed))
    open_units = known.select(
        "doc_id", "source", "size", "copies",
        (F.floor(rate) * F.col("copies") + F.floor(extra)).cast("bigint").alias("whole"),
        (extra - F.floor(extra)).alias("share"),
        F.pmod(spot, F.ceil(F.col("_rows") / units_per_block).cast("bigint")).alias("block"),
        spot.alias("spot"),
    )
    # in the order of a hash, so that the last open units have all kinds of sizes, whose sums lie densely
    blocks = open_units.repartition("source", "block").sortWithinPartitions("source", "block", "spot", "doc_id", "size")
    flown = stage(blocks.mapInPandas(_fly(("source", "block"), seed, False), UNIT), "flown")
    is_open = (F.col("share") > 0) & (F.col("share") < 1)
    left = flown.filter(is_open).repartition("source").sortWithinPartitions("source", "spot", "doc_id", "size")
    landed = left.mapInPandas(_fly(("source",), seed, True), UNIT)
    settled = flown.filter(~is_open).unionByName(landed)
    all_copies = F.col("whole") + F.col("share").cast("bigint")
    nth = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("_nth")
    each = settled.select("doc_id", "source", "size", "copies", all_copies.alias("_all"), nth)
    copies = F.floor(F.col("_all") / F.col("copies")) + (F.col("_nth") < F.col("_all") % F.col("copies")).cast("bigint")
    facts = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return each.join(facts, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("bigint").alias("taken_copies")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by words. A NULL text has no words."""
    mixed = mix(table(spark, sf_dir, "documents"), count_words(F.col("text")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("taken_copies")).alias("taken"), "source"
    )
