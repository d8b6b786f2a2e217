"""SentencePiece encoding by sampling without replacement, and exact decoding.

The pieces of a public model make a lattice over a text; a segmentation's weight is the
product of its pieces' weights. The search keeps, for every part of the tree of
segmentations it has not opened, the largest Gumbel-perturbed log probability in it, opens
the part with the largest, and so emits distinct segmentations in the order of Gumbel top-k.

No piece crosses the begin of a word, so a text's lattice is that of its words in a row; a
word's lattice is built once and remembered.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from itertools import chain, repeat
from pathlib import Path as Path_

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import kept_by_worker, map_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 20240609
SPACE = "▁"  # what stands for a space in pieces; fixed by the model
# A space sign in the text itself is no space and is spelled in bytes.
SPACE_SIGN = "\U0010fffe"
CUT = "\0"
CHUNKS = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
# Edges of remembered words, 24 bytes each. Those of the first words met, which have nearly all frequent ones, stay;
# the others are forgotten when there are too many.
KEPT_EDGES, MOST_EDGES = 2_500_000, 4_000_000
# Words whose lattices are built together, and characters that are sampled together; both bound the memory of a task.
WORDS_AT_ONCE, CHARACTERS_AT_ONCE = 8_000, 300_000
# No uniform number of 24 bits, as the parts beside a path get, makes a larger Gumbel number.
MOST_GUMBEL = 17.4
DEPTH = 20.0  # log probability down to which open parts are looked at first


class Pieces:
    """The vocabulary: pieces with log weights, and bytes for characters without a piece."""

    def __init__(self, model: bytes):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = processor.get_piece_size()
        self.byte_ids = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(n) if processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i)}
        pieces = [(processor.id_to_piece(i), i, processor.get_score(i)) for i in range(n) if i not in special]
        if any(re.search(f"[^{SPACE}]{SPACE}|\n.|.\n", p) for p, _, _ in pieces):
            raise ValueError("a piece crosses the begin of a word or a line")
        # the model orders its pieces by frequency: weights fall as the inverse of the rank
        self.weight = np.zeros(n)
        for rank, (_, i, _) in enumerate(sorted(pieces, key=lambda p: (-p[2], p[1]))):
            self.weight[i] = -np.log(rank + 2.0)
        self.byte_weight = -np.log(len(pieces) + 2.0)
        self.weight[self.byte_ids] = self.byte_weight
        self.bytes = [b""] * n
        for piece, i, _ in pieces:
            self.bytes[i] = piece.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.spelled = pa.array(self.bytes, pa.large_binary())
        self.longest = max(len(p) for p, _, _ in pieces)
        # by length: hashes of all that pieces begin with, in order; the piece's id or -1; whether a longer piece begins so
        self.table: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool))]
        ids = {p: i for p, i, _ in pieces}
        longer = {p[:k] for p, _, _ in pieces for k in range(1, len(p))}
        starts = [(p, ids.get(p, -1), p in longer) for p in sorted(longer.union(ids))]
        for length in range(1, self.longest + 1):
            some = [s for s in starts if len(s[0]) == length]
            points = np.array([[ord(c) for c in p] for p, _, _ in some], dtype=np.uint64).reshape(-1, length)
            h = np.zeros(len(some), dtype=np.uint64)
            for k in range(length):
                h = _extend(h, points[:, k])
            if len(np.unique(h)) < len(h):
                raise ValueError("two beginnings of pieces share a hash")
            order = np.argsort(h)
            self.table.append((h[order], np.array([i for _, i, _ in some], dtype=np.int64)[order], np.array([m for *_, m in some], dtype=bool)[order]))

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of a segmentation; the space that encoding puts in front is taken off."""
        data = self.spell(np.asarray(ids, dtype=np.int64))
        return data[1:].decode("utf-8", "replace") if data[:1] == b" " else data.decode("utf-8", "replace")

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of pieces in a row: those of Arrow's values lie one after the other."""
        _, ends, values = self.spelled.take(pa.array(ids)).buffers()
        return values.to_pybytes()[: np.frombuffer(ends, dtype=np.int64)[len(ids)]] if len(ids) else b""


def _extend(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hashes of strings that are longer by one character."""
    x = (h ^ (points + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def random_bits(key: np.ndarray, a: np.ndarray, b: int) -> np.ndarray:
    """64 well mixed bits for each key and place, of a stream `b`."""
    x = key ^ (a * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((b * 0xD1B54A32D192ED03 + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers within (0, 1), at least 2^-54 away from both ends."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def prepare(text: str) -> list[str]:
    """The words of a text as chunks that no piece crosses; none for the empty text."""
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, SPACE_SIGN)
    if "  " not in text and text[0] != " " and CUT not in text:
        # where single spaces lead all words, cutting before them is the same and much faster
        cut = text.replace(" ", CUT + SPACE)
        if "\n" not in text:
            return (SPACE + cut).split(CUT)
        return [c for c in (SPACE + cut.replace("\n", f"{CUT}\n{CUT}")).split(CUT) if c]
    return CHUNKS.findall(SPACE + text.replace(" ", SPACE))


class Lattices:
    """The lattices of all words met, as tables of nodes (places in words) and edges (pieces).

    Edges of a node come in falling order of their chance, which is conditional on the node:
    weights are summed over all ways to the end of the word.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.root: dict[str, int] = {}
        self.kept: tuple[dict[str, int], int, int] | None = None
        self.n_nodes = self.n_edges = 0
        self.first = np.zeros(1 << 12, dtype=np.int64)  # of each node's edges, and their end as one more
        self.next = np.empty(1 << 14, dtype=np.int32)  # node after the edge, -1 for the end of the word
        self.node = np.empty(1 << 14, dtype=np.int32)  # that the edge leaves
        self.id = np.empty(1 << 14, dtype=np.int32)  # piece, or -1 - character for one spelled in several bytes
        self.chance_log = np.empty(1 << 14)
        self.below = np.empty(1 << 14, dtype=np.float32)  # chance of this edge and of those before it

    def roots(self, chunks: list[str]) -> np.ndarray:
        """First node of every chunk's lattice."""
        found = self._found(chunks)
        if found.min(initial=0) < 0:
            if self.n_edges > MOST_EDGES:
                kept, self.n_nodes, self.n_edges = self.kept
                self.root = dict(kept)
                found = self._found(chunks)
            absent = np.flatnonzero(found < 0)
            missing = [chunks[i] for i in absent.tolist()]
            new = sorted(set(missing))
            for at in range(0, len(new), WORDS_AT_ONCE):
                self._build(new[at : at + WORDS_AT_ONCE])
            if self.kept is None and self.n_edges > KEPT_EDGES:
                self.kept = dict(self.root), self.n_nodes, self.n_edges
            found[absent] = self._found(missing)
        return found

    def _found(self, chunks: list[str]) -> np.ndarray:
        """First node of every chunk's lattice, -1 for a chunk that is not remembered."""
        return np.fromiter(map(self.root.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))

    def _build(self, chunks: list[str]) -> None:
        lengths = np.array([len(c) for c in chunks])
        ends = np.cumsum(lengths)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        n = len(points)
        left = np.repeat(ends, lengths) - np.arange(n)  # characters from here to the end of the word
        starts, ids, sizes = [], [], []
        h, at = np.zeros(n, dtype=np.uint64), np.arange(n)
        has_single = np.zeros(n, dtype=bool)
        for size in range(1, self.pieces.longest + 1):
            keep = left[at] >= size
            at, h = at[keep], h[keep]
            if not len(at):
                break
            h = _extend(h, points[at + size - 1])
            hashes, numbers, longer = self.pieces.table[size]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            begins = np.flatnonzero(hashes[place] == h)
            place = place[begins]
            number = numbers[place]
            is_piece = number >= 0
            found = at[begins[is_piece]]
            starts.append(found)
            ids.append(number[is_piece])
            sizes.append(np.full(len(found), size))
            if size == 1:
                has_single[found] = True
            # only where a longer piece begins with these characters is it worth to look further
            further = begins[longer[place]]
            at, h = at[further], h[further]
        lone = np.flatnonzero(~has_single)
        starts.append(lone)
        unknown = points[lone].astype(np.int64)
        ids.append(np.where(unknown < 128, np.array(self.pieces.byte_ids)[unknown & 127], -1 - unknown))
        sizes.append(np.ones(len(lone), dtype=np.int64))
        start, piece, size = np.concatenate(starts), np.concatenate(ids), np.concatenate(sizes)
        weight = np.where(piece >= 0, self.pieces.weight[np.maximum(piece, 0)], self.pieces.byte_weight * utf8_size(-1 - piece))
        # sums over all ways to the end, from the words' last characters backwards
        order = np.argsort((left[start] * (n + 1) + start) * (self.pieces.longest + 1) + size)  # one key sorts faster
        start, piece, size, weight = start[order], piece[order], size[order], weight[order]
        total = np.zeros(n + 1)
        rest = left[start]
        cuts = np.flatnonzero(np.diff(rest)) + 1
        ways = np.empty(len(start))
        for a, b in zip([0, *cuts], [*cuts, len(start)]):
            after = np.where(size[a:b] == rest[a], 0.0, total[np.minimum(start[a:b] + size[a:b], n)])
            ways[a:b] = weight[a:b] + after
            node = np.flatnonzero(np.diff(start[a:b], prepend=-1))
            top = np.maximum.reduceat(ways[a:b], node)
            counts = np.diff(np.append(node, b - a))
            total[start[a:b][node]] = top + np.log(np.add.reduceat(np.exp(ways[a:b] - np.repeat(top, counts)), node))
        chance_log = ways - total[start]
        order = np.argsort(start * 1024.0 - np.maximum(chance_log, -1000.0))
        start, piece, size, chance_log = start[order], piece[order], size[order], chance_log[order]
        chance = np.exp(chance_log)
        first = np.searchsorted(start, np.arange(n + 1))
        summed = np.cumsum(chance)
        below = summed - np.repeat(np.concatenate([[0.0], summed])[first[:-1]], np.diff(first))
        below[first[1:] - 1] = 1.0  # the last edge takes what rounding leaves
        node_at, edge_at = self.n_nodes, self.n_edges
        following = np.where(size == left[start], -1, start + size + node_at)
        self.first = _put(self.first, node_at + 1, first[1:] + edge_at)
        self.next = _put(self.next, edge_at, following)
        self.node = _put(self.node, edge_at, start + node_at)
        self.id = _put(self.id, edge_at, piece)
        self.chance_log = _put(self.chance_log, edge_at, chance_log)
        self.below = _put(self.below, edge_at, below)
        self.n_nodes, self.n_edges = node_at + n, edge_at + len(start)
        self.root.update(zip(chunks, (node_at + ends - lengths).tolist()))


def _put(table_of: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """The table with values put in, in a quarter more room if it is full."""
    if at + len(values) > len(table_of):
        table_of = np.concatenate([table_of[:at], np.empty((at + len(values)) * 5 // 4 - at, dtype=table_of.dtype)])
    table_of[at : at + len(values)] = values
    return table_of


def utf8_size(points: np.ndarray) -> np.ndarray:
    points = np.where(points == ord(SPACE_SIGN), ord(SPACE), points)
    return 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)


class Path:
    """A sampled segmentation of one text: its edges, the log chance before each, and its perturbed value."""

    __slots__ = ("edges", "words", "before", "value", "number", "new_from")

    def __init__(self, edges: np.ndarray, words: np.ndarray, before: np.ndarray, value: float, number: int, new_from: int):
        self.edges, self.words, self.before, self.value, self.number, self.new_from = edges, words, before, value, number, new_from


class Sampler:
    """Emits distinct segmentations of texts, largest perturbed log probability first."""

    def __init__(self, pieces: Pieces, seed: int = SEED):
        self.pieces, self.lattices, self.seed = pieces, Lattices(pieces), seed

    def batch(self, texts: list[str], keys: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For every text up to `k` segmentations as (ids, log probability, perturbed value, log inclusion score).

        The inclusion score is the chance that the segmentation is among the `k`, given the
        value of the next one; it is 1 (0 in log) if the text has no further segmentation.
        """
        chunks = [prepare(t) for t in texts]
        flat = list(chain.from_iterable(chunks))
        roots = self.lattices.roots(flat)
        counts = np.array([len(c) for c in chunks], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        key_bits = np.array([(x * 0x9E3779B97F4A7C15 + self.seed) % (1 << 64) for x in keys], dtype=np.uint64)
        key_bits = random_bits(key_bits, np.zeros(len(keys), dtype=np.uint64), 0)
        roots_of = [roots[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
        # the best of all segmentations of a text: a Gumbel number, for their chances add up to one
        values = -np.log(-np.log(uniform(random_bits(key_bits, np.zeros(len(keys), dtype=np.uint64), 1))))
        opened: list[list] = [[] for _ in texts]  # heaps of the parts not opened yet
        done: list[list[Path]] = [[] for _ in texts]
        paths = self._walk(list(range(len(texts))), roots_of, key_bits, [None] * len(texts), values, 0)
        for number in range(k):
            ids = [i for i, p in enumerate(paths) if p is not None]
            for i in ids:
                done[i].append(paths[i])
            self._open(ids, paths, key_bits, opened, k - number)
            if number + 1 == k:
                break
            begins, chosen = [], []
            for i in ids:
                if opened[i]:
                    value, _, parent, at, edge = heapq.heappop(opened[i])
                    chosen.append(i)
                    begins.append((parent, at, edge, -value))
            paths = [None] * len(texts)
            if chosen:
                found = self._walk(chosen, roots_of, key_bits, begins, np.array([b[3] for b in begins]), number + 1)
                for i, path in zip(chosen, found):
                    paths[i] = path
        out = []
        for i in range(len(texts)):
            limit = -opened[i][0][0] if opened[i] else -np.inf
            rows = []
            for path in done[i]:
                total = float(self.lattices.chance_log[path.edges].sum())
                rows.append((self.ids_of(path.edges), total, path.value, log_inclusion(total - limit)))
            out.append(rows)
        return out

    def ids_of(self, edges: np.ndarray) -> np.ndarray:
        ids = self.lattices.id[edges]
        if len(ids) and ids.min() < 0:
            out: list[int] = []
            for i in ids.tolist():
                if i >= 0:
                    out.append(i)
                else:
                    character = chr(-1 - i)
                    data = (SPACE if character == SPACE_SIGN else character).encode("utf-8", "replace")
                    out += [self.pieces.byte_ids[b] for b in data]
            return np.array(out, dtype=np.int64)
        return ids

    def _walk(self, texts: list[int], roots_of, key_bits, begins, values, number: int) -> list[Path]:
        """Sample the rest of a segmentation of each text, all words side by side.

        `begins` gives the path that it leaves, where, and by which edge; None for a whole new one.
        """
        lattices = self.lattices
        node, owner, word, heads, first_word = [], [], [], [], []
        for j, (i, begin) in enumerate(zip(texts, begins)):
            roots = roots_of[i]
            if begin is None:
                heads.append((np.empty(0, np.int64), np.empty(0, np.int64)))
                start, some = 0, roots
            else:
                parent, at, edge, _ = begin
                heads.append((np.append(parent.edges[:at], edge), parent.words[: at + 1]))
                start = int(parent.words[at])
                some = roots[start:].copy()
                some[0] = lattices.next[edge]  # the rest of the word, if any
            first_word.append(start)
            node.append(some)
            owner.append(np.full(len(some), j))
            word.append(np.arange(start, start + len(some)))
        node, owner, word = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (node, owner, word))
        bits = key_bits[np.array(texts, dtype=np.int64)][owner] if len(node) else np.empty(0, np.uint64)
        place = np.arange(len(node))
        steps_edge, steps_place = [], []
        live = node >= 0
        node, place_now, bits_now = node[live], place[live], bits[live]
        word_now = word[live].astype(np.uint64) << np.uint64(20)
        step = 0
        while len(node):
            # a word of more than a million pieces would use its numbers again, which does no harm
            u = uniform(random_bits(bits_now, word_now + np.uint64(step % (1 << 20)), 2 + 2 * number))
            edge = lattices.first[node]
            late = np.flatnonzero(u >= lattices.below[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] >= lattices.below[edge[late]]]
            steps_edge.append(edge)
            steps_place.append(place_now)
            node = lattices.next[edge].astype(np.int64)
            on = node >= 0
            if not on.all():
                node, place_now, bits_now, word_now = node[on], place_now[on], bits_now[on], word_now[on]
            step += 1
        sizes = np.zeros(len(place), dtype=np.int64)
        for p in steps_place:
            sizes[p] += 1
        starts = np.concatenate([[0], np.cumsum(sizes)])
        edges, words = np.empty(starts[-1], dtype=np.int64), np.repeat(word, sizes)
        for s, (e, p) in enumerate(zip(steps_edge, steps_place)):
            edges[starts[p] + s] = e
        per_text = np.bincount(owner, sizes, minlength=len(texts)).astype(np.int64) if len(owner) else np.zeros(len(texts), np.int64)
        cut = np.concatenate([[0], np.cumsum(per_text)])
        out = []
        for j in range(len(texts)):
            head_edges, head_words = heads[j]
            all_edges = np.concatenate([head_edges, edges[cut[j] : cut[j + 1]]])
            all_words = np.concatenate([head_words, words[cut[j] : cut[j + 1]]])
            before = np.concatenate([[0.0], np.cumsum(lattices.chance_log[all_edges])[:-1]]) if len(all_edges) else np.empty(0)
            out.append(Path(all_edges, all_words, before, float(values[j]), number, len(head_edges)))
        return out

    @staticmethod
    def _largest(values: np.ndarray, groups: np.ndarray, wanted: int) -> np.ndarray:
        """Places, in order, of the `wanted` largest values of each group, and of those equal to the least of them; groups are runs."""
        if not len(values):
            return np.empty(0, dtype=np.int64)
        start = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1))
        size = np.diff(np.append(start, len(groups)))
        rest, taken = values, np.zeros(len(values), dtype=bool)
        for _ in range(wanted):
            at_top = rest == np.repeat(np.maximum.reduceat(rest, start), size)
            taken |= at_top
            rest = np.where(at_top, -np.inf, rest)
        return np.flatnonzero(taken)

    def _open(self, texts: list[int], paths: list[Path | None], key_bits: np.ndarray, opened: list[list], wanted: int) -> None:
        """Put the `wanted` best parts beside every path into its text's heap.

        Beside a path of value T lies, for every other edge of its nodes, the part of the tree behind
        that edge. Its largest perturbed value is a Gumbel number at its log chance, cut off at T.
        Deep parts cannot hold a large value and are looked at only if needed.
        """
        lattices = self.lattices
        depth = {i: DEPTH for i in texts}
        waiting = list(texts)
        while waiting:
            node_edge, node_before, node_bits, node_value, node_text, node_at = [], [], [], [], [], []
            for i in waiting:
                p = paths[i]
                deep = int(np.searchsorted(-p.before, depth[i], side="right"))
                part = slice(p.new_from, max(deep, p.new_from))
                count = part.stop - part.start
                node_edge.append(p.edges[part])
                node_before.append(p.before[part])
                node_bits.append(np.full(count, key_bits[i]))
                node_value.append(np.full(count, p.value))
                node_text.append(np.full(count, i))
                node_at.append(np.arange(part.start, part.stop))
            edge, before, bits, value, text, at = map(np.concatenate, (node_edge, node_before, node_bits, node_value, node_text, node_at))
            node = lattices.node[edge]
            first, n = lattices.first[node], lattices.first[node + 1] - lattices.first[node]
            which = np.repeat(np.arange(len(node)), n)
            other = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[which]
            beside = other != edge[which]
            which, other = which[beside], other[beside]
            chance = before[which] + lattices.chance_log[other]
            spot = (at[which].astype(np.uint64) << np.uint64(12)) + (other - first[which]).astype(np.uint64)
            number = paths[waiting[0]].number
            u = ((random_bits(bits[which], spot, 3 + 2 * number) >> np.uint64(40)).astype(np.float64) + 0.5) * 2.0**-24
            gumbel = chance - np.log(-np.log(u))
            # beside one path all are cut off alike, which keeps their order: only the largest are looked at further
            largest = self._largest(gumbel, text[which], wanted)
            which, other, gumbel = which[largest], other[largest], gumbel[largest]
            # -log(exp(-ceiling) + exp(-chance) * -log(u)), without leaving the range of doubles
            best = -np.logaddexp(-value[which], -gumbel)
            order = np.lexsort((-best, text[which]))
            ranked_text = text[which][order]
            start = np.searchsorted(ranked_text, waiting)
            end = np.searchsorted(ranked_text, waiting, side="right")
            still = []
            for i, a, b in zip(waiting, start, end):
                chosen = order[a : min(b, a + wanted)]
                whole = not len(paths[i].before) or -paths[i].before[-1] <= depth[i]
                if not whole and (len(chosen) < wanted or best[chosen[-1]] < MOST_GUMBEL - depth[i]):
                    depth[i] *= 4
                    still.append(i)
                    continue
                for c in chosen:
                    where = which[c]
                    heapq.heappush(opened[i], (-float(best[c]), number * 10_000_000 + int(c), paths[i], int(at[where]), int(other[c])))
            waiting = still


def log_inclusion(excess: float) -> float:
    """log(1 - exp(-exp(excess))): the chance that a Gumbel number at `excess` exceeds 0."""
    if excess < -30:
        return excess
    if excess == np.inf or excess > 5:
        return 0.0 if excess > 40 else float(np.log1p(-np.exp(-np.exp(excess))))
    return float(np.log(-np.expm1(-np.exp(excess))))


def parts(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about `CHARACTERS_AT_ONCE`; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHARACTERS_AT_ONCE:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if texts:
        yield slice(start, len(texts))


ENCODED = "rank int, ids array<int>, n_pieces int, log_prob double, score double, log_inclusion double, round_trip boolean"


def encode(
    df: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES, model: str = MODEL, seed: int = SEED
) -> DataFrame:
    """Up to `samples` distinct segmentations of every text, drawn without replacement.

    Returns `key, rank, ids, n_pieces, log_prob, score, log_inclusion, round_trip`: one row per
    segmentation, `score` being the perturbed log probability that ranks them and `round_trip`
    whether decoding gives the text again. Draws follow from the key, an integer, and the text: repeated
    rows get the same ones, a NULL key counts as 0. A NULL text counts as empty; the empty text has one segmentation without
    pieces. Texts with fewer segmentations than `samples` give fewer rows. An empty table gives an empty one.
    """
    proto, token = Path_(model).read_bytes(), uuid.uuid4().hex
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = kept_by_worker(token, lambda: Sampler(Pieces(proto), seed))
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for part in parts(texts):
                yield rows_of(sampler, texts[part], batch.column(key).slice(part.start, part.stop - part.start))

    def rows_of(sampler: Sampler, texts: list[str], keys: pa.Array) -> pa.RecordBatch:
        pieces = sampler.pieces
        found = sampler.batch(texts, [int(i or 0) for i in keys.to_pylist()], samples)
        owner = [i for i, rows in enumerate(found) for _ in rows]
        rows = [r for some in found for r in some]
        sizes = np.array([len(r[0]) for r in rows], dtype=np.int64)
        flat = np.concatenate([r[0] for r in rows]).astype(np.int32) if rows else np.empty(0, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
        trip = [pieces.decode(r[0]) == texts[i] for i, r in zip(owner, rows)]
        columns = [
            keys.take(pa.array(owner, pa.int64())),
            pa.array([n for some in found for n in range(1, len(some) + 1)], pa.int32()),
            ids,
            pa.array(sizes.astype(np.int32)),
            *[pa.array([r[c] for r in rows], pa.float64()) for c in (1, 2, 3)],
            pa.array(trip, pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[key, *[c.split()[0] for c in ENCODED.split(", ")]])

    return map_batches(df.select(key, F.col(text).alias("_text")), run, f"`{key}` {kind}, {ENCODED}", token)


def decode(df: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """Add `text`, decoded from piece ids; NULL ids give NULL."""
    proto = Path_(model).read_bytes()
    kept = [c for c in df.columns if c != "text"]
    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(proto)
        for batch in batches:
            texts = [None if i is None else pieces.decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, "text"])

    return map_batches(df.select(*kept), run, f"{schema}text string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two segmentations of every document, seeded by its id."""
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
