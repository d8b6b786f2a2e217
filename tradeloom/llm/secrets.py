"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

Tokens are words. The field tags each as secret begin, inside or outside from its shape, the words
around it and features of the whole text. It is trained here, on windows around pattern
matches, on plain windows and on the same windows with made-up secrets put in.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import WORD, map_batches, table

# Patterns and least lengths of the base spans. Fixed by the contract.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "crf")
SPAN_COLUMNS = ["starts", "ends", "kinds"]
REDACTED = "[SECRET]"

WORDS = re.compile(WORD)
# What stands around a value inside its word.
LEAD = re.compile(r"[\"'`(\[{<]*(?:[A-Za-z_-]{2,20}[\"']?[:=][\"']?)?")
TAIL = "\"'`)]}>,;.!?*#%&$|:"

PLAIN = [("plain", f"plain{n}") for n in range(6)]

BEGIN, INSIDE, OUTSIDE = 0, 1, 2
FEATURE_SPACE = 1 << 12
SAMPLE_DOCUMENTS = 400  # of each kind, with and without a pattern match
SNIPPET = 600  # characters of each that the field is trained on
EPOCHS = 80
SEED = 7


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of all base spans, by start, then kind."""
    found = []
    if "=" in text or ":" in text:
        found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def secret_parts(text: str) -> list[tuple[int, int]]:
    """The values themselves: of an assignment only what is assigned."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    parts += [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return parts + [m.span() for m in HEX.finditer(text)]


@lru_cache(maxsize=1 << 16)
def _number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=4).digest(), "little") % FEATURE_SPACE


def core_of(word: str) -> tuple[int, int]:
    """Where in the word its value starts and ends, without quotes, brackets, marks and a leading name."""
    start, end = LEAD.match(word).end(), len(word.rstrip(TAIL))
    return (start, end) if start < end else (0, len(word))


def shape_features(word: str) -> tuple[str, ...]:
    """What the word looks like."""
    letters = word.rstrip(".,;!?")
    if letters.isalpha() and len(letters) < 24 and (letters.islower() or letters[1:].islower() or len(letters) == 1):
        return PLAIN[len(letters) // 4]
    start, end = core_of(word)
    core = word[start:end]
    n = len(core)
    digits = sum(c.isdigit() for c in core)
    upper = sum(c.isupper() for c in core)
    lower = sum(c.islower() for c in core)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in core]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    out = [
        f"n{min(n, 40) // 4}",
        f"mix{int(digits > 0)}{int(upper > 0)}{int(lower > 0)}{int(digits + upper + lower < n)}",
        f"mix{int(digits > 0)}{int(upper > 0)}{int(lower > 0)},n{min(n, 40) // 8}",
        f"digits{min(10 * digits // max(n, 1), 9)}",
        f"changes{min(10 * changes // max(n, 1), 9)},n{min(n, 40) // 8}",
        f"distinct{min(len(set(core)), 20) // 2}",
    ]
    if n and all(c in "0123456789abcdef" for c in core):
        out.append(f"hex{min(n, 40) // 8}")
    if all(c in string.ascii_letters + string.digits + "+/_=-" for c in core):
        out.append("base64")
    if "@" in core or core.count(".") > 1:
        out.append("address")
    if start and ("=" in word[:start] or ":" in word[:start]):
        out.append("named")
    if word[:1] in "\"'`":
        out.append("quoted")
    return tuple(out)


def signature(word: str, names: frozenset[str]) -> tuple[tuple[str, ...], str | None, str]:
    """All that the field sees of a word: its shape, whether it is a known name, and a last = or :."""
    name = word.strip("\"'`()[]{}<>,;.!?|*#%&$").rstrip(":=").lower()
    return shape_features(word), name if name in names else None, word[-1] if word[-1:] in ("=", ":") else ""


def word_features(seen: tuple[tuple[str, ...], str | None, str]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Feature numbers of a word for itself, the next, the one after that, and the one before."""
    shapes, name, sign = seen
    own = [_number(f"own {s}") for s in shapes]
    after, second, before = [], [], []
    if name is not None:
        own.append(_number(f"own word {name}"))
        after.append(_number(f"after {name}"))
        second.append(_number(f"second after {name}"))
        before.append(_number(f"before {name}"))
    if sign:
        after.append(_number(f"after sign {sign}"))
    before.append(_number(f"before {shapes[0]}"))
    after.append(_number(f"after {shapes[0]}"))
    return own, after, second, before


def file_features(n_words: int, n_odd: int, n_signs: int) -> list[int]:
    """Features of the whole text: its length, and how much of it looks like data or settings."""
    share = min(20 * n_odd // max(n_words, 1), 9)
    return [
        _number(f"file length {min(n_words.bit_length(), 12)}"),
        _number(f"file odd {share}"),
        _number(f"file signs {min(n_signs, 3)}"),
    ]


@dataclass(frozen=True)
class Field:
    """A trained field: weights by feature and tag, transitions, starts, and the known context words."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    names: frozenset[str]

    def margin(self) -> float:
        """The most that any other tag can gain over outside by its transitions.

        A word whose tag scores favour outside by more is outside on every best path.
        """
        into = np.maximum(self.moves, self.start[None, :])
        gain = [
            self.moves[a, x] + self.moves[x, c] - self.moves[a, OUTSIDE] - self.moves[OUTSIDE, c]
            for a in range(3) for x in (BEGIN, INSIDE) for c in range(3)
        ]
        gain += [self.start[x] + self.moves[x, c] - self.start[OUTSIDE] - self.moves[OUTSIDE, c] for x in (0, 1) for c in range(3)]
        # a last word has no transition after it
        gain += [into[a, x] - self.moves[a, OUTSIDE] for a in range(3) for x in (BEGIN, INSIDE)]
        gain += [self.start[x] - self.start[OUTSIDE] for x in (BEGIN, INSIDE)]
        return max(0.0, float(max(gain)))

    def viterbi(self, scores: np.ndarray, first: bool) -> np.ndarray:
        """Best tags of a run; before it stands an outside word, or nothing if it is the first.

        What follows a run is outside or nothing, for which `scores` may hold an outside word.
        """
        best = scores[0] + (self.start if first else self.moves[OUTSIDE])
        back = np.zeros((len(scores), 3), dtype=np.int8)
        for t in range(1, len(scores)):
            ways = best[:, None] + self.moves
            back[t] = ways.argmax(axis=0)
            best = ways.max(axis=0) + scores[t]
        tags = np.empty(len(scores), dtype=np.int8)
        tags[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(sequences: list[tuple[list[list[int]], list[int]]], names: frozenset[str], epochs: int = EPOCHS) -> Field:
    """Maximise the conditional likelihood of the tags by forward-backward and Adam."""
    sequences = [s for s in sequences if s[1]]
    longest = max((len(tags) for _, tags in sequences), default=1)
    widest = max((len(f) for features, _ in sequences for f in features), default=1)
    n = len(sequences)
    # feature number FEATURE_SPACE is padding and keeps the weight 0
    ids = np.full((n, longest, widest), FEATURE_SPACE, dtype=np.int32)
    gold = np.full((n, longest), OUTSIDE, dtype=np.int64)
    mask = np.zeros((n, longest), dtype=bool)
    for i, (features, tags) in enumerate(sequences):
        for t, own in enumerate(features):
            ids[i, t, : len(own)] = own
        gold[i, : len(tags)], mask[i, : len(tags)] = tags, True
    shapes = [(FEATURE_SPACE + 1, 3), (3, 3), (3,)]
    values = [np.zeros(s) for s in shapes]
    values[1][OUTSIDE, INSIDE] = -4.0
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    target = np.eye(3)[gold] * mask[:, :, None]
    for epoch in range(1, epochs + 1 if n else 1):
        weights, moves, start = values
        scores = weights[ids].sum(axis=2)
        ahead = np.zeros((n, longest, 3))
        behind = np.zeros((n, longest, 3))
        ahead[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            step = log_sum(ahead[:, t - 1, :, None] + moves, axis=1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = log_sum(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        total = log_sum(ahead[:, -1], axis=1)
        chance = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        off = target - chance
        grads = [np.zeros(s) for s in shapes]
        for tag in range(3):
            grads[0][:, tag] = np.bincount(
                ids.ravel(), np.repeat(off[:, :, tag].ravel(), widest), minlength=FEATURE_SPACE + 1
            )
        for t in range(1, longest):
            live = mask[:, t]
            pair = ahead[live, t - 1, :, None] + moves + (scores[live, t] + behind[live, t])[:, None, :]
            expected = np.exp(pair - total[live, None, None]).sum(axis=0)
            np.add.at(grads[1], (gold[live, t - 1], gold[live, t]), 1.0)
            grads[1] -= expected
        grads[2] = off[:, 0].sum(axis=0)
        for k in range(3):
            g = grads[k] / n - 1e-4 * values[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            values[k] = values[k] + 0.15 * (first[k] / (1 - 0.9**epoch)) / (np.sqrt(second[k] / (1 - 0.99**epoch)) + 1e-8)
        values[0][FEATURE_SPACE] = 0.0
    if not n:
        values[2][OUTSIDE] = 1.0
    return Field(values[0], values[1], values[2], names)


# Context words and forms of made-up secrets for training. Plain values, in natural order.
SECRET_NAMES = (
    "access_key apikey api_key auth authorization bearer client_secret credential credentials key passphrase passwd"
    " password private_key pwd secret secret_key signature token"
).split()
SECRET_FORMS = ("hex", "letters and digits", "base64", "prefixed", "uuid", "upper")


def made_up_secret(rng: random.Random) -> str:
    form = rng.choice(SECRET_FORMS)
    n = rng.randrange(16, 48)
    if form == "hex":
        return "".join(rng.choices("0123456789abcdef", k=n))
    if form == "base64":
        return "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=n)) + "=" * rng.randrange(3)
    if form == "prefixed":
        prefix = "".join(rng.choices(string.ascii_lowercase, k=rng.randrange(2, 4)))
        return f"{prefix}_" + "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    if form == "uuid":
        return "-".join("".join(rng.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12))
    if form == "upper":
        return "".join(rng.choices(string.ascii_uppercase + string.digits, k=20))
    return "".join(rng.choices(string.ascii_letters + string.digits, k=n))


def decoy(rng: random.Random) -> str:
    """Something with digits or signs that is no secret."""

    def letters(least: int, most: int) -> str:
        return "".join(rng.choices(string.ascii_lowercase, k=rng.randrange(least, most)))

    def digits(n: int) -> str:
        return "".join(rng.choices(string.digits, k=n))

    return rng.choice(
        [
            lambda: f"{letters(2, 8)}.{digits(rng.randrange(1, 4))}@{letters(3, 7)}{digits(1)}.{letters(4, 9)}.com",
            lambda: f"{letters(3, 9)}@{letters(4, 9)}.org",
            lambda: f"https://www.{letters(4, 9)}.net/{letters(3, 9)}/{digits(rng.randrange(1, 6))}?page={digits(1)}",
            lambda: ".".join(digits(rng.randrange(1, 4)) for _ in range(4)),
            lambda: f"+{digits(rng.randrange(8, 14))}",
            lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: digits(rng.randrange(1, 20)),
            lambda: f"{digits(4)}-{digits(2)}-{digits(2)}",
            lambda: f"{digits(rng.randrange(1, 3))}.{digits(rng.randrange(1, 3))}",
            lambda: f"{letters(3, 9)}_{letters(3, 9)}.{letters(2, 4)}",
            lambda: f"{letters(4, 9)}-{letters(4, 9)}-{letters(4, 9)}",
            lambda: letters(15, 30),
            lambda: letters(4, 12).upper() + "!!",
            lambda: letters(4, 12) + rng.choice(["***", "$$$", "%%%", "###", "&&&"]),
            lambda: f"<{letters(1, 5)}>",
            lambda: f"{letters(3, 9)}:",
        ]
    )() + rng.choice(["", "", "", ".", ",", "!!", "***", "###"])


def _with_decoys(words: list[str], tags: list[int], rng: random.Random) -> tuple[list[str], list[int]]:
    out_words, out_tags = [], []
    for word, tag in zip(words, tags):
        if tag == OUTSIDE and rng.random() < 0.1:
            for part in decoy(rng).split(" "):
                out_words.append(part)
                out_tags.append(OUTSIDE)
        out_words.append(word)
        out_tags.append(tag)
    return out_words, out_tags


def _planted(words: list[str], rng: random.Random) -> tuple[list[str], list[int]]:
    """The words with a made-up secret put in, and their tags."""
    at = rng.randrange(len(words) + 1)
    quote = rng.choice(['"', "'", "", ""])
    name, sign = rng.choice(SECRET_NAMES), rng.choice([":", "="])
    secret = f"{quote}{made_up_secret(rng)}{quote}"
    lead = rng.choice([[name, sign], [name + sign], [name], [], [], None])
    if lead is None:
        put, tags = [f"{name}{sign}{secret}"], [BEGIN]
    else:
        put, tags = [*lead, secret], [OUTSIDE] * len(lead) + [BEGIN]
        if rng.random() < 0.1:  # a secret over two words
            put, tags = [*put, f"{quote}{made_up_secret(rng)}{quote}"], [*tags, INSIDE]
    return words[:at] + put + words[at:], [OUTSIDE] * at + tags + [OUTSIDE] * (len(words) - at)


def _features(words: list[str], names: frozenset[str]) -> list[list[int]]:
    parts = [word_features(signature(w, names)) for w in words]
    odd = sum(not w.isalpha() for w in words)
    whole = file_features(len(words), odd, sum(w[-1] in "=:" for w in words))
    out = []
    for t, (own, *_) in enumerate(parts):
        here = own + whole
        if t >= 1:
            here = here + parts[t - 1][1]
        if t >= 2:
            here = here + parts[t - 2][2]
        if t + 1 < len(parts):
            here = here + parts[t + 1][3]
        out.append(here)
    return out


def train(snippets: list[str], seed: int = SEED, epochs: int = EPOCHS) -> Field:
    """A field from pieces of texts: their pattern matches, and made-up secrets put in."""
    rng = random.Random(seed)
    names = frozenset([*SECRET_NAMES, *(n.replace("_", "") for n in SECRET_NAMES), "=", ":", ""])
    examples = []
    for snippet in sorted(snippets) or ["a plain line of words"]:
        spans = [(m.start(), m.end()) for m in WORDS.finditer(snippet)]
        parts = secret_parts(snippet)
        words = [snippet[a:b] for a, b in spans]
        tags = [BEGIN if any(a < e and s < b for s, e in parts) else OUTSIDE for a, b in spans]
        marked = [t for t, tag in enumerate(tags) if tag == BEGIN]
        at = max(0, marked[0] - rng.randrange(10)) if marked else rng.randrange(max(1, len(words) - 20))
        words, tags = words[at : at + 24], tags[at : at + 24]
        examples.append(_with_decoys(words, tags, rng))
        if BEGIN not in tags:
            examples.append(_planted(words[:18], rng))
    return fit([(_features(w, names), t) for w, t in examples if w], names, epochs)


class Scanner:
    """Finds all spans of a text. Keeps what it knows of words, up to a number of them."""

    MOST_WORDS = 300_000

    def __init__(self, field: Field):
        self.field = field
        self.margin = field.margin()
        self.clear()

    def clear(self) -> None:
        """Forget all words; of each, the rows hold what the field sees, and there are few kinds of that."""
        self.known: dict[str, int] = {}
        self.kinds: dict[tuple, int] = {}
        self.rows = np.zeros((4, 256, 3))
        self.odd = np.zeros((256, 2), dtype=np.int64)

    def _learn(self, word: str) -> int:
        seen = (signature(word, self.field.names), not word.isalpha())
        at = self.kinds.get(seen, -1)
        if at < 0:
            at = self.kinds[seen] = len(self.kinds)
            if at == len(self.odd):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)], axis=1)
                self.odd = np.concatenate([self.odd, np.zeros_like(self.odd)])
            for k, numbers in enumerate(word_features(seen[0])):
                self.rows[k, at] = self.field.weights[numbers].sum(axis=0) if numbers else 0.0
            self.odd[at] = (seen[1], bool(seen[0][2]))
        self.known[word] = at
        return at

    def scores(self, words: list[str]) -> np.ndarray:
        """Tag scores of every word, without transitions."""
        if len(self.known) > self.MOST_WORDS:
            self.clear()
        known = self.known
        ids = np.array([known[w] if w in known else self._learn(w) for w in words], dtype=np.int64)
        odd, signs = np.bincount(ids, minlength=len(self.odd)) @ self.odd
        own, after, second, before = self.rows
        total = own.take(ids, axis=0)
        total += self.field.weights[file_features(len(words), int(odd), int(signs))].sum(axis=0)
        total[1:] += after.take(ids[:-1], axis=0)
        total[2:] += second.take(ids[:-2], axis=0)
        total[:-1] += before.take(ids[1:], axis=0)
        return total

    def tagged(self, text: str) -> list[tuple[int, int]]:
        """Spans that the field tags as secrets, by Viterbi over the words that may be one."""
        words = WORDS.findall(text)
        if not words:
            return []
        scores = self.scores(words)
        other = np.maximum(scores[:, BEGIN], scores[:, INSIDE])
        open_at = np.flatnonzero(scores[:, OUTSIDE] - other <= self.margin)
        if not len(open_at):
            return []
        secret = []  # runs of word numbers
        for run in np.split(open_at, np.flatnonzero(np.diff(open_at) > 1) + 1):
            first, last = int(run[0]), int(run[-1])
            # the outside word after the run closes it
            tags = self.field.viterbi(scores[first : last + 2], first == 0)[: last + 1 - first]
            for t in np.flatnonzero(tags != OUTSIDE):
                if tags[t] == INSIDE and t and tags[t - 1] != OUTSIDE:
                    secret[-1][1] = first + int(t)
                else:
                    secret.append([first + int(t), first + int(t)])
        if not secret:
            return []
        places = [m.span() for m in WORDS.finditer(text)]
        out = []
        for a, b in secret:
            start, end = places[a][0] + core_of(words[a])[0], places[b][0] + core_of(words[b])[1]
            out.append((start, end))
        return out

    def redacted(self, text: str) -> str:
        """The text with every secret, of an assignment only its value, replaced by `REDACTED`."""
        parts = sorted(secret_parts(text) + [(a, b) for a, b, kind in self.spans(text) if KINDS[kind] == "crf"])
        out, at = [], 0
        for a, b in parts:
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], REDACTED]
            at = b
        return "".join([*out, text[at:]]) if out else text

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Base spans and, where they touch none of these, those of the field; by start, then kind."""
        found = base_spans(text)
        added = [
            (a, b, 3) for a, b in self.tagged(text) if a < b and not any(a < e and s < b for s, e, _ in found)
        ]
        return sorted(found + added, key=lambda s: (s[0], s[2], s[1]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def sample_snippets(df: DataFrame, text: str = "text", documents: int = SAMPLE_DOCUMENTS) -> list[str]:
    """Pieces of at most `SNIPPET` characters of a fixed number of texts, chosen by hash.

    Half of the texts match a base pattern. This bounded sample trains the field; every
    text is scanned.
    """
    pattern = f"(?i:{ASSIGN.pattern})|AKIA[A-Z0-9]{{16,}}|[0-9a-f]{{24,}}"
    spot = F.xxhash64(text)
    place = F.regexp_instr(text, F.lit(pattern))
    matching = df.select(spot.alias("_spot"), text, place.alias("_at")).filter(F.col("_at") > 0)
    near = F.substring(text, F.greatest(F.col("_at") - SNIPPET // 3, F.lit(1)), F.lit(SNIPPET))
    somewhere = (F.pmod(F.xxhash64(text, F.lit(1)), F.length(text)) + 1).cast("int")
    plain = df.filter(F.length(text) > 0).select(F.substring(text, somewhere, F.lit(SNIPPET)).alias("_piece"), spot.alias("_spot"))
    pieces = [
        matching.select("_spot", near.alias("_piece")),
        plain.select("_spot", "_piece"),
    ]
    return [r[0] for p in pieces for r in p.distinct().orderBy("_spot", "_piece").limit(documents).select("_piece").collect()]


def scan(df: DataFrame, field: Field, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row's spans: `starts, ends` (code points, end exclusive) and `kinds`, as arrays.

    The columns of `keep` come along, by default all; columns of the three new names are
    replaced. A NULL text counts as empty and has no spans.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in SPAN_COLUMNS]
    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(field)
        for batch in batches:
            found = [scanner.spans(t or "") for t in batch.column("_text").to_pylist()]
            added = [
                pa.array([[s[0] for s in f] for f in found], pa.list_(pa.int64())),
                pa.array([[s[1] for s in f] for f in found], pa.list_(pa.int64())),
                pa.array([[KINDS[s[2]] for s in f] for f in found], pa.list_(pa.string())),
            ]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *added], names=[*kept, *SPAN_COLUMNS])

    given = df.select(*kept, F.col(text).alias("_text"))
    return map_batches(given, run, f"{schema}starts array<bigint>, ends array<bigint>, kinds array<string>")


def redact(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """All rows with the secrets of their texts replaced; other columns and NULL texts stay."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(field)
        for batch in batches:
            texts = [None if t is None else scanner.redacted(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, text, pa.array(texts, batch.schema.field(at).type))

    return map_batches(df, run, schema)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the secrets in all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(documents, train(sample_snippets(documents)), keep=["doc_id"])
    each = F.arrays_zip("kinds", "starts", "ends")

    def listed(spans: Column) -> Column:
        named = F.transform(spans, lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"]))
        return F.array_join(named, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")

    base = listed(F.filter(each, lambda s: s["kinds"] != "crf"))
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS], F.sha2(base, 256).alias("base_sha256"), listed(each).alias("spans")
    )
