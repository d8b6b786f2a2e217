"""Near-duplicate documents: an exact Jaccard join of word shingles that uses relations between sets.

An inverted index over the prefixes of the sets (rarest shingles first) keeps every entry's
position. A list's first entry, its leader, is compared with the whole list. The answers of the others are derived
from the leader's: sets that are already connected need no comparison, and the overlaps with
the leader bound their own overlaps. What is left is joined by list and size block, where
positions rule out most pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import map_batches, settled, table, unstage

# Fixed by the contract: shingles of five words; two sets link where 7 * overlap >= 3 * (sizes).
SHINGLE_WORDS = 5
# Shingles whose hash lies in this part of the hash space are counted over all sets and come
# first in the order of shingles; a bit more than the quarter of a set that its prefix takes.
COUNTED_PART = 0.27
LEADER_ROUNDS = 2
# Size of the filter for sets that may have partners; more sets than bits only make it let all through.
FILTER_BITS = 1 << 24
WORDS_AT_ONCE = 100_000
# Bits of a set's parity signature, in words of 64.
SIGNATURE_WORDS = 6
# Shingles before an entry that are compared to tell whether a pair has met already.
EARLIER = 16
# Parts of the hash space that are shuffled one after the other, so that the disk holds one of them at a time.
SLICES = 4
# Sets that a task remembers, to pass over copies.
REMEMBERED_SETS = 100_000

_RANDOM = np.random.RandomState(20240601)
_BYTES = _RANDOM.randint(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """64-bit hashes of all shingles of a text, from prefix sums over its bytes."""

    def __init__(self, size: int = SHINGLE_WORDS):
        self.size = size
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; empty for a text without words."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(words) <= WORDS_AT_ONCE:
            return np.unique(self._some(words))
        step = WORDS_AT_ONCE - self.size + 1
        parts = [words[a : a + WORDS_AT_ONCE] for a in range(0, len(words) - self.size + 1, step)]
        return np.unique(np.concatenate([np.unique(self._some(p)) for p in parts]))

    def _some(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, dtype=np.uint64)
        joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
        if len(joined) + 1 > len(self.powers):
            n = 2 * len(joined) + 1
            self.powers, self.inverse = _powers(_BASE, n), _powers(_INVERSE, n)
        sums = np.zeros(len(joined) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[joined] * self.powers[: len(joined)], out=sums[1:])
        gaps = np.flatnonzero(joined == 32)
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])
        take = min(self.size, len(words))
        first, last = starts[: len(words) - take + 1], ends[take - 1 :]
        raw = (sums[last] - sums[first]) * self.inverse[first]
        return _mix(raw + _mix((last - first).astype(np.uint64)))


def set_keys(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set; the first is its node in the graph."""
    a, b = _mix(hashes).sum(dtype=np.uint64), _mix(hashes ^ _BASE).sum(dtype=np.uint64)
    return int(np.int64(a.astype(np.int64))), int(np.int64(b.astype(np.int64)))


def prefix_size(n: int) -> int:
    """Two linked sets share a shingle among the first so many of each, in any common order."""
    return n - (3 * n + 3) // 4 + 1


def listed_shingles(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles a set may have in its prefix, and how many of them are counted ones.

    These are all counted ones and, if a prefix needs more, the next by hash.
    """
    counted = int(np.searchsorted(hashes, np.uint64(int(COUNTED_PART * (1 << 64)))))
    return hashes[: max(counted, min(prefix_size(len(hashes)), len(hashes)))], counted


def _sliced(hashes: np.ndarray, part: float = 1.0) -> list[np.ndarray]:
    """Sorted hashes by equal slices of the lower `part` of the hash space; the last slice takes all above."""
    ends = np.searchsorted(hashes, np.array([int(part * (1 << 64)) // SLICES * i for i in range(1, SLICES)], dtype=np.uint64))
    return [h.view(np.int64) for h in np.split(hashes, ends)]


def _columns_of_slices(name: str) -> list[str]:
    return [f"{name}_{i}" for i in range(SLICES)]


def _batches(df: DataFrame, text: str, columns: list[str], row, schema: str) -> DataFrame:
    """One row for each `row(shingle hashes, sets of this task)` that is not None, after the kept columns."""
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}
    kept = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)

    def column(values: list, kind: pa.DataType) -> pa.Array:
        if not pa.types.is_list(kind):
            return pa.array(values, kind)
        ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, dtype=np.int64), *values])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, met = Shingler(), set()
        for batch in batches:
            found = [row(shingler.hashes(t), met) for t in batch.column("_text").to_pylist()]
            keep = [i for i, r in enumerate(found) if r is not None]
            chosen = batch.take(pa.array(keep, pa.int64()))
            new = [column([found[i][k] for i in keep], kinds[kind]) for k, (_, kind) in enumerate(fields)]
            names = [*columns, *[n for n, _ in fields]]
            yield pa.RecordBatch.from_arrays([*[chosen.column(c) for c in columns], *new], names=names)

    return map_batches(df.select(*columns, F.col(text).alias("_text")), run, kept + schema)


def parity_signature(hashes: np.ndarray) -> np.ndarray:
    """One bit per part of the hash space: whether the set has an odd number of shingles there.

    Two sets differ in at least as many shingles as their signatures differ in bits.
    """
    bits = 64 * SIGNATURE_WORDS
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _is_new(keys: tuple[int, int], met: set) -> bool:
    """Whether the task does not remember the set. Later copies of it can be left out, which saves disk and changes nothing."""
    if keys in met:
        return False
    if len(met) >= REMEMBERED_SETS:
        met.clear()
    met.add(keys)
    return True


def _listed(hashes: np.ndarray, met: set):
    keys = set_keys(hashes)
    tokens, counted = listed_shingles(hashes)
    return (*keys, len(hashes), counted, *_sliced(tokens if _is_new(keys, met) else tokens[:0], COUNTED_PART))


def components(edges: DataFrame) -> DataFrame:
    """`node, label` of every node in `a, b`: the smallest node that it is connected with.

    Labels spread to neighbours and then jump to their label's label, until their sum stands
    still. Each round is stored in the shared folder, which cuts the lineage.
    """
    pairs = edges.select("a", "b")
    both = settled(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    last = None
    while (now := labels.agg(total).first()[0]) != last:
        last = now
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        jumped = labels.join(further, "label").select("node", F.col("_next").alias("label"))
        spread = both.join(jumped.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        before, labels = labels, settled(jumped.unionByName(spread).groupBy("node").agg(F.min("label").alias("label")), "labels")
        unstage(before)
    unstage(both)
    return labels


def _linked(overlap: Column, a: Column, b: Column) -> Column:
    return overlap * 7 >= (a + b) * 3


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct `a < b` with their sizes, from columns `x, x_size, y, y_size`."""
    first = F.col("x") < F.col("y")
    return df.select(
        F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"),
        F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"),
        F.when(first, F.col("x_size")).otherwise(F.col("y_size")).alias("a_size"),
        F.when(first, F.col("y_size")).otherwise(F.col("x_size")).alias("b_size"),
    ).distinct()


def _overlaps(pairs: DataFrame, shingles: DataFrame, label: str) -> DataFrame:
    """Add the exact `overlap` of every pair, from the sets' whole shingle lists. The result is stored.

    An overlap is the sum of those of the slices, of which one is shuffled at a time. Of the stored copies of a set one is chosen.
    """
    chosen = shingles.groupBy("node").agg(F.min("row").alias("_row"))
    for side in ("a", "b"):
        pairs = pairs.join(chosen.select(F.col("node").alias(side), F.col("_row").alias(f"{side}_row")), side)
    pairs = settled(pairs, "pairs")
    parts = []
    for name in _columns_of_slices("shingles"):
        left = shingles.select(F.col("row").alias("a_row"), F.col(name).alias("_left"))
        right = shingles.select(F.col("row").alias("b_row"), F.col(name).alias("_right"))
        common = F.size(F.array_intersect("_left", "_right")).cast("bigint")
        found = pairs.join(left, "a_row").join(right, "b_row").select("a", "b", "a_size", "b_size", common.alias("overlap"))
        parts.append(settled(found, "overlaps"))
    total = reduce(DataFrame.unionByName, parts).groupBy("a", "b", "a_size", "b_size").agg(F.sum("overlap").alias("overlap"))
    total = settled(total, label)
    unstage(pairs, *parts)
    return total


def shared_entries(hashed: DataFrame) -> list[DataFrame]:
    """`token, node`: the entries of lists of more than one set, each once; a stored frame for every slice of the hash space.

    Most shingles are in one set only, so that nearly all entries are shuffled for nothing but to learn that.
    """
    parts = []
    for name in _columns_of_slices("tokens"):
        entries = hashed.select("node", F.explode(name).alias("token")).repartition("token")  # both sides read this shuffle
        nodes = entries.groupBy("token").agg(F.min("node").alias("_first"), F.max("node").alias("_last"))
        several = nodes.filter(F.col("_first") < F.col("_last")).select("token")
        parts.append(settled(entries.join(several, "token").distinct(), "listed"))
    return parts


def prefix_index(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """`token, node, n, place, before`: the entries of all lists, with places in the common order.

    `entries` are the shared ones. `before` is the entry's predecessor among the node's entries.

    Counted shingles come first, by how many sets have them, then by hash; the others
    follow by hash. A shingle that only one set lists can have no part in a link, so it has no entry, but counts
    for the places of the others. The index is stored.
    """
    counts = entries.groupBy("token").agg(F.count("*").alias("sets"))
    shared = entries.join(counts, "token").join(sizes.select("node", "n", "counted"), "node")
    # unsigned order of the hashes, as in the lists
    unsigned = F.col("token").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
    limit = int(COUNTED_PART * (1 << 64)) - (1 << 63)
    is_counted = unsigned < F.lit(limit).cast("bigint")
    mine = Window.partitionBy("node")
    order = mine.orderBy(F.desc("_counted"), F.when(F.col("_counted"), F.col("sets")), "_unsigned")
    placed = shared.withColumns({"_counted": is_counted, "_unsigned": unsigned}).withColumns(
        {
            "_shared": F.count(F.when(F.col("_counted"), 1)).over(mine),
            "_nth": F.row_number().over(order),
            "before": F.lag("token").over(order),
        }
    )
    # entries after the counted ones: their true place is at least this, which only weakens a bound
    place = F.when(F.col("_counted"), F.col("counted") - F.col("_shared") + F.col("_nth") - 1)
    place = F.coalesce(place, F.col("counted") + F.col("_nth") - F.col("_shared") - 1)
    prefix = F.col("n") - F.floor((F.col("n") * 3 + 3) / 4) + 1
    index = placed.select("token", "node", "n", place.cast("bigint").alias("place"), "before").filter(F.col("place") < prefix)
    return settled(index, "index")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", count_links: bool = False) -> DataFrame:
    """`key, n_shingles, component_id` of every row, and with `count_links` also `n_links`.

    Rows of equal shingle sets are one node of the graph. The links between different
    sets are found exactly; of a component that is already known to be connected no further pairs are
    compared, unless links are counted: `n_links` is the exact number of other rows that a row is linked with, and
    takes all pairs of a group. Texts without words, and NULL, are linked with nothing. `component_id` is the
    smallest key of the component; NULL keys are passed over, and a component of nothing
    else has a NULL id. Repeated keys are rows of their own. An empty table gives an empty one.
    """
    # the lists are a part of what the hashes give: stored beside them, so that one pass over the texts makes both
    slices = _columns_of_slices("tokens")
    schema = "node bigint, other bigint, n bigint, counted bigint, " + ", ".join(f"{s} array<bigint>" for s in slices)
    hashed = settled(_batches(df, text, [key], _listed, schema), "hashed")
    listed = shared_entries(hashed)
    rows = settled(hashed.drop(*slices), "sets")
    unstage(hashed)
    sizes = rows.filter(F.col("n") > 0).groupBy("node", "other", "n", "counted").agg(F.min(key).alias("first"))
    sizes = settled(sizes, "sizes")
    index = prefix_index(reduce(DataFrame.unionByName, listed), sizes)
    unstage(*listed)
    labels, active, shingles = _find_links(df, text, index)
    if not count_links:
        unstage(active, shingles)
    known = sizes.join(labels, "node", "left").select("node", "other", F.coalesce("label", "node").alias("label"), "first")
    smallest = settled(known.groupBy("label").agg(F.min("first").alias("component_id")), "smallest")
    found = settled(known.join(smallest, "label").select("node", "other", "component_id"), "found")
    columns = [key, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id")]
    if count_links:
        copies = settled(rows.filter(F.col("n") > 0).groupBy("node", "other").agg(F.count("*").alias("copies")), "copies")
        linked = copies.join(_linked_copies(active, shingles, copies), "node", "left")
        found = found.join(linked, ["node", "other"])
        n_links = F.col("copies") - 1 + F.coalesce("linked", F.lit(0))
        columns.append(F.coalesce(n_links, F.lit(0)).alias("n_links"))
    return rows.join(found, ["node", "other"], "left").select(*columns)


def _find_links(df: DataFrame, text: str, index: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The components' labels, the entries of lists of more than one set, and the whole sets of these."""

    def leaders(entries: DataFrame) -> DataFrame:
        lists = entries.groupBy("token").agg(
            F.min(F.struct("place", "n", "node")).alias("_first"), F.count("*").alias("_entries")
        )
        lists = lists.filter(F.col("_entries") > 1)
        return settled(lists.select("token", F.col("_first.node").alias("leader"), F.col("_first.n").alias("leader_n")), "leaders")

    lists = leaders(index)
    active = settled(index.join(lists, "token"), "active")
    unstage(index, lists)
    shingles = _whole_sets(df, text, active.select("node").distinct())
    compared = links = labels = None
    entries, stars_of_rounds = active, []
    for _ in range(LEADER_ROUNDS):
        followers = entries.filter(F.col("node") != F.col("leader"))
        stars = _pairs(followers.select(
            F.col("leader").alias("x"), F.col("leader_n").alias("x_size"), F.col("node").alias("y"), F.col("n").alias("y_size")
        ))
        found = _overlaps(stars, shingles, "stars")
        stars_of_rounds.append(found)
        compared = found if compared is None else compared.unionByName(found)
        links = compared.filter(_linked(F.col("overlap"), F.col("a_size"), F.col("b_size"))).select("a", "b")
        unstage(labels)
        labels = components(links)
        # the sets of a list that its leader is not connected with follow a leader of their own
        away = _with_labels(active, labels).filter(F.col("label") != F.col("leader_label"))
        followed, led = entries, away.select("token", "node", "n", "place", "before")
        first = leaders(led)
        entries = settled(led.join(first, "token"), "followers")
        unstage(first, None if followed is active else followed)
    unstage(entries)
    remaining, *done = _remaining_pairs(_with_labels(active, labels), compared, shingles)
    remaining = settled(remaining, "remaining")
    unstage(*done)
    compared = _overlaps(remaining, shingles, "compared")
    more = compared.filter(_linked(F.col("overlap"), F.col("a_size"), F.col("b_size")))
    links = settled(links.unionByName(more.select("a", "b")), "links")
    unstage(remaining, compared, labels, *stars_of_rounds)
    labels = components(links)
    unstage(links)
    return labels, active, shingles


def _linked_copies(active: DataFrame, shingles: DataFrame, copies: DataFrame) -> DataFrame:
    """`node, linked`: how many rows the sets have that a set is linked with, without its own rows.

    All pairs of a list that no bound rules out are compared, also within components.
    """
    seen = ("node", "n", "place", "before", "signature")
    split = settled(active.join(_signatures(shingles), "node").select("token", *seen, _block().alias("block")), "split")
    probes = split.select("token", *[F.col(c).alias(f"y_{c}") for c in seen], _near_blocks().alias("block"))
    met = split.join(probes, ["token", "block"]).filter((F.col("node") < F.col("y_node")) & _meets_first() & _possible())
    pairs = _pairs(met.select(
        F.col("node").alias("x"), F.col("n").alias("x_size"), F.col("y_node").alias("y"), F.col("y_n").alias("y_size")
    ))
    compared = _overlaps(pairs, shingles, "compared")
    links = compared.filter(_linked(F.col("overlap"), F.col("a_size"), F.col("b_size"))).select("a", "b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of_other = copies.select(F.col("node").alias("b"), "copies")
    return both.join(of_other, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("linked"))


def _block() -> Column:
    """Linked sets lie in the same block of sizes or in blocks beside each other."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int")


def _near_blocks() -> Column:
    return F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))


def _meets_first() -> Column:
    """Whether an entry and a probe of its list have not met by the shingle before."""
    return ~F.coalesce(F.col("before") == F.col("y_before"), F.lit(False))


def _possible() -> Column:
    """Whether places, sizes and signatures of an entry and of a probe of its list allow a link whose first shingle is here."""
    x_size, y_size = F.col("n"), F.col("y_n")
    from_here = F.least(x_size - F.col("place"), y_size - F.col("y_place"))
    differ = sum(
        (F.bit_count(F.get("signature", F.lit(i)).bitwiseXOR(F.get("y_signature", F.lit(i)))) for i in range(SIGNATURE_WORDS)),
        F.lit(0),
    )
    fits = (F.least(x_size, y_size) * 4 >= F.greatest(x_size, y_size) * 3) & (differ * 7 <= x_size + y_size)
    return _linked(from_here, x_size, y_size) & fits


def _with_labels(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the labels of the entry's node and of its list's leader."""
    own = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_leader = labels.select(F.col("node").alias("leader"), F.col("label").alias("leader_label"))
    return own.join(of_leader, "leader", "left").withColumn("leader_label", F.coalesce("leader_label", "leader"))


def _signatures(shingles: DataFrame) -> DataFrame:
    return shingles.groupBy("node").agg(F.min("signature").alias("signature"))


def _remaining_pairs(entries: DataFrame, compared: DataFrame, shingles: DataFrame) -> tuple[DataFrame, ...]:
    """Pairs of a list whose link would connect two components and that no bound rules out.

    After the pairs come the stored frames that they are read from. One of the two is not connected with the leader. Lists are split into blocks by size, of which a
    probe reads its own and the two beside it. A pair is needed only in the list of its first common shingle:
    never where both sets have one of the `EARLIER` shingles before in common, and elsewhere only if their
    places allow it. These shingles are taken from the open lists alone: each list of two sets of different components
    is open. The overlaps of both with the leader bound their own, and so do their signatures. As entries and probes are
    wide, a slice of the lists is shuffled at a time.
    """
    overlap = compared.select(F.col("a").alias("leader"), F.col("b").alias("node"), "overlap").unionByName(
        compared.select(F.col("b").alias("leader"), F.col("a").alias("node"), "overlap")
    )
    away = F.col("label") != F.col("leader_label")
    open_lists = settled(entries.filter(away).select("token").distinct(), "open")
    known = entries.join(open_lists, "token").join(overlap.distinct(), ["leader", "node"], "left")
    shared = F.when(F.col("node") == F.col("leader"), F.col("n")).otherwise(F.col("overlap"))
    split = known.join(_signatures(shingles), "node").select(
        "token", "node", "n", "place", "label", "leader_label", "signature", shared.alias("shared"), _block().alias("block")
    )
    earlier = Window.partitionBy("node").orderBy("place").rowsBetween(-EARLIER, -1)
    split = settled(split.withColumn("earlier", F.collect_list("token").over(earlier)), "split")
    seen = ("node", "n", "place", "earlier", "label", "shared", "signature")
    probes = split.filter(away).select("token", *[F.col(c).alias(f"y_{c}") for c in seen], _near_blocks().alias("block"))
    x_size, y_size, x_shared, y_shared = F.col("n"), F.col("y_n"), F.col("shared"), F.col("y_shared")
    from_leader = F.least(x_shared + y_size - y_shared, y_shared + x_size - x_shared)
    enough = F.coalesce(_linked(from_leader, x_size, y_size), F.lit(True))
    once = (F.col("label") == F.col("leader_label")) | (F.col("node") < F.col("y_node"))
    is_first = ~F.arrays_overlap("earlier", "y_earlier")
    parts = []
    for number in range(SLICES):
        here = F.pmod("token", F.lit(SLICES)) == number
        met = split.filter(here).join(probes.filter(here), ["token", "block"])
        met = met.filter((F.col("label") != F.col("y_label")) & once & enough & _possible() & is_first)
        parts.append(settled(_pairs(met.select(
            F.col("node").alias("x"), x_size.alias("x_size"), F.col("y_node").alias("y"), y_size.alias("y_size")
        )), "pairs"))
    pairs = reduce(DataFrame.unionByName, parts).distinct()
    return pairs.join(compared.select("a", "b").distinct(), ["a", "b"], "left_anti"), open_lists, split, *parts


def _whole_sets(df: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """`row, node`, its shingles by slices and `signature` of the wanted sets, from a second pass over the texts.

    A bitmap of a fixed number of bits drops most other texts; the few that pass it meet nothing in later joins. Copies of a set that
    lie in different tasks are all stored, each with a `row` of its own, as taking them out here would need the disk for all sets twice.
    """
    spot = F.col("node").bitwiseAND(F.lit(FILTER_BITS - 1).cast("bigint"))
    bit = F.expr(f"shiftleft(1L, int((node & {FILTER_BITS - 1}L) & 63L))")
    found = wanted.groupBy(F.shiftright(spot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for word, value in found:
        bits[word] = value
    packed = bits.view(np.uint64)

    def whole(hashes: np.ndarray, met: set):
        if not len(hashes):
            return None
        keys = set_keys(hashes)
        at = keys[0] & (FILTER_BITS - 1)
        if not (int(packed[at >> 6]) >> (at & 63)) & 1 or not _is_new(keys, met):
            return None
        return keys[0], parity_signature(hashes), *_sliced(hashes)

    lists = ", ".join(f"{s} array<bigint>" for s in _columns_of_slices("shingles"))
    found = _batches(df, text, [], whole, "node bigint, signature array<bigint>, " + lists)
    return settled(found.withColumn("row", F.monotonically_increasing_id()), "shingles")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates among all documents."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS place FROM worded
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[place:place + 4], ' ') AS shingle FROM places
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)
), reached AS (
  SELECT doc_id AS start, doc_id AS node FROM documents
  UNION SELECT start, b FROM reached JOIN links ON a = node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT start, min(node) AS component_id FROM reached GROUP BY start) ON start = d.doc_id
"""
