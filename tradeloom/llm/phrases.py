"""Collocations by relational mining: occurrences of phrases as sorted relations.

The texts of a language are taken apart into chunks of some million tokens. The relation of level k
holds, chunk by chunk and sorted by position, where each frequent phrase of k words begins. A separator of pieces or
documents takes a position of its own, so that two occurrences belong together exactly if one begins a position
after the other. A level is merged with itself on adjacent positions, which gives the candidates of the next (two
overlapping phrases of k words are one of k + 1), stored in order. Their groups are counted: per chunk first, then
over all. The frequent groups go back to the chunks that hold them, and the semi-join there leaves
the next level.

Nothing is sampled or capped. What is shuffled are the groups of each chunk, so a very common phrase is one row
per chunk, and a chunk's occurrences, whole, to the groups that it holds. A text longer than a chunk goes on in
the next one, which begins with the words before it; what lies in these alone was counted before.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import map_batches, settled, stage, table

# Fixed by the contract: pieces end at these, words of a piece at a blank or a tab.
SEPARATORS = ".,;:!?\n\x0b\x0c\r"
TOKEN = re.compile(r"[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]")
BETWEEN = re.compile(r"[\x20\x09.,;:!?\x0A-\x0D]")
NO_LANG = "und"
FEWEST = 100
LONGEST = 5
TOP = 2000

# Characters of a text that are taken apart at once; tokens after which a chunk ends; tokens that a task holds.
TEXT_AT_ONCE = 1 << 20
TOKENS_AT_ONCE = 1 << 20
TOKENS_HELD = 1 << 22
# Chunks of a task, and candidates of a chunk, are numbered in so many bits.
NUMBER_BITS = 21
# Levels that are told apart in one pass.
_LEVELS = 2


# --- tokens ---


def tokens_of(text: str) -> Iterator[list[str]]:
    """The words and separators of a text, in order, in lists of limited length."""
    # bytes.lower changes A to Z alone
    text = text.encode("utf-8", "replace").lower().decode()
    start = 0
    while start < len(text):
        cut = BETWEEN.search(text, start + TEXT_AT_ONCE)
        end = cut.start() if cut else len(text)
        yield TOKEN.findall(text, start, end)
        start = end


class Chunk:
    """Consecutive tokens of one language as places of their words; -1 is a separator.

    The first `seen` tokens are the end of the chunk before, where a text goes on.
    """

    def __init__(self, before: list[str] = ()) -> None:
        self.words: list[str] = []
        self.places = dict.fromkeys(SEPARATORS, -1)
        self.tokens = array("i")
        self.add(before)
        self.seen = len(before)

    def add(self, tokens: list[str]) -> None:
        places, words = self.places, self.words
        for token in tokens:
            place = places.get(token)
            if place is None:
                place = places[token] = len(words)
                words.append(token)
            self.tokens.append(place)

    def last(self, count: int) -> list[str]:
        return [SEPARATORS[0] if p < 0 else self.words[p] for p in self.tokens[-count:]]

    def counts(self) -> np.ndarray:
        """How often each word is new here."""
        new = np.frombuffer(self.tokens, np.int32)[self.seen :]
        return np.bincount(new[new >= 0], minlength=len(self.words))


def chunks_of(texts: Iterator[tuple[str, str]], overlap: int) -> Iterator[tuple[str, Chunk]]:
    """The texts (language, text) cut into chunks. A text ends in a separator, or goes on in the next chunk after `overlap` tokens."""
    held: dict[str, Chunk] = {}
    size = 0
    for lang, text in texts:
        for part in tokens_of(text):
            if lang not in held:
                held[lang] = Chunk()
            held[lang].add(part)
            size += len(part)
            full = lang
            if len(held[lang].tokens) < TOKENS_AT_ONCE:
                if size < TOKENS_HELD:
                    continue
                full = max(held, key=lambda name: len(held[name].tokens))
            chunk = held.pop(full)
            size -= len(chunk.tokens)
            yield full, chunk
            if full == lang:
                held[lang] = Chunk(chunk.last(overlap))
                size += len(held[lang].tokens)
        if lang in held:
            held[lang].add(SEPARATORS[:1])
            size += 1
    yield from held.items()


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers from -1 on, first the lowest byte of each, then the next: high bytes are alike, which compresses well."""
    return (numbers.astype(np.int32) + 1).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int32) - 1


def token_chunks(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """`chunk, lang, seen, words, counts, tokens`: the distinct words of a chunk, how often each is new in it, and all tokens, packed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << NUMBER_BITS
        texts = (pair for b in batches for pair in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()))
        for number, (name, chunk) in enumerate(chunks_of(texts, longest - 1)):
            columns = [[first + number], [name], [chunk.seen], [chunk.words], [chunk.counts()], [packed(np.frombuffer(chunk.tokens, np.int32))]]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "lang", "seen", "words", "counts", "tokens"]
            )

    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(text, F.lit("")).alias("text")
    )
    return map_batches(texts, cut, "chunk bigint, lang string, seen int, words array<string>, counts array<bigint>, tokens binary")


# --- levels ---


def merged(at: np.ndarray, phrase: np.ndarray, seen: int, length: int) -> tuple[np.ndarray, ...]:
    """Occurrences of `length` words from those of one word less: (at, candidate, a, b, count).

    `at` is sorted and `phrase` says what begins there. A candidate is the place of a pair in `a` and `b`;
    it counts where it does not lie in the first `seen` tokens alone.
    """
    first = np.flatnonzero(at[1:] == at[:-1] + 1)
    names, place = np.unique(phrase, return_inverse=True)
    code = place[first].astype(np.int64) * len(names) + place[first + 1]
    pairs, candidate = np.unique(code, return_inverse=True)
    begin = at[first]
    counts = np.bincount(candidate[begin > seen - length], minlength=len(pairs))
    size = max(len(names), 1)
    return begin, candidate, names[pairs // size], names[pairs % size], counts


def _named(candidate: np.ndarray, kept: pa.Table, length: int) -> np.ndarray:
    """The number of each occurrence's group of `length` words, -1 where it is not frequent."""
    names = np.full(int(candidate.max(initial=-1)) + 2, -1, np.int64)  # the last is for separators
    mark, number = kept.column("mark").to_numpy(), kept.column("id").to_numpy()
    own = mark % _LEVELS == length % _LEVELS
    names[mark[own] // _LEVELS] = number[own]
    return names[candidate]


def _next_level(at: np.ndarray, candidate: np.ndarray, kept: pa.Table, seen: int, length: int) -> tuple[np.ndarray, ...]:
    """The candidates of one word more, from those of `length` words of which the frequent are kept."""
    phrase = _named(candidate, kept, length)
    frequent = phrase >= 0
    return merged(at[frequent], phrase[frequent], seen, length + 1)


def _word_pairs(chunks: DataFrame, kept: DataFrame) -> DataFrame:
    """The groups of two words of every chunk: `here, a, b, count`."""

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens = unpacked(left.column("tokens")[0].as_buffer())
        _, _, a, b, counts = _next_level(np.arange(len(tokens)), tokens, right, left.column("seen")[0].as_py(), 1)
        here = (left.column("chunk")[0].as_py() << NUMBER_BITS) + np.arange(len(a))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (here, a, b, counts)], ["here", "a", "b", "count"])

    left = chunks.select("chunk", "seen", "tokens").groupBy("chunk")
    return left.cogroup(kept.groupBy("chunk")).applyInArrow(merge, "here bigint, a bigint, b bigint, count bigint")


def _occurrences(relation: DataFrame, kept: DataFrame, length: int) -> DataFrame:
    """The candidates of `length` words by chunk: `chunk, seen, at, candidate` and their groups `a, b, counts`.

    `kept` has the frequent groups of the level before in each chunk. For three words the relation is the tokens, and `kept`
    those of both levels before. Candidates are packed. `at` is a bit for every position, as candidates are sorted by it.
    """

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        seen = left.column("seen")[0].as_py()
        candidate = unpacked(left.column("candidate")[0].as_buffer())
        if length == 3:
            at, candidate, *_ = _next_level(np.arange(len(candidate)), candidate, right, seen, 1)
        else:
            at = np.flatnonzero(np.unpackbits(np.frombuffer(left.column("at")[0].as_buffer(), np.uint8)))
        begin, found, a, b, counts = _next_level(at, candidate, right, seen, length - 1)
        places = np.zeros(int(begin.max(initial=-1)) + 1, bool)
        places[begin] = True
        binary = [pa.array([v], pa.binary()) for v in (np.packbits(places).tobytes(), packed(found))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int64())) for v in (a, b, counts)]
        keys = [pa.array([left.column(c)[0].as_py()], k) for c, k in (("chunk", pa.int64()), ("seen", pa.int32()))]
        return pa.Table.from_arrays([*keys, *binary, *lists], ["chunk", "seen", "at", "candidate", "a", "b", "counts"])

    schema = "chunk bigint, seen int, at binary, candidate binary, a array<bigint>, b array<bigint>, counts array<bigint>"
    left = relation.select("chunk", "seen", "at", "candidate").groupBy("chunk")
    return left.cogroup(kept.groupBy("chunk")).applyInArrow(merge, schema)


def _here(group: str) -> Column:
    """Chunk and candidate as one number."""
    return F.shiftleft("chunk", NUMBER_BITS).bitwiseOR(F.col(group).cast("bigint")).alias("here")


def _frequent(groups: DataFrame, by: list[str], fewest: int) -> DataFrame:
    """The rows of frequent groups, one for each chunk, with the group's number `id`, that of its first row.

    That row, where `here` is `id`, says what the group is and how often it occurs, `f`.
    """
    group = Window.partitionBy(*by)
    counted = groups.withColumn("f", F.sum("count").over(group)).filter(F.col("f") >= fewest)
    named = counted.withColumn("id", F.min("here").over(group))
    named = named.select("here", "id", *[F.when(F.col("here") == F.col("id"), F.col(c)).alias(c) for c in (*by, "f")])
    return named.sortWithinPartitions("here")


def _marks(kept: DataFrame, length: int) -> DataFrame:
    """`chunk, mark, id` of frequent groups; the mark is the candidate, and the level beside it."""
    candidate = F.col("here").bitwiseAND(F.lit((1 << NUMBER_BITS) - 1).cast("bigint"))
    mark = (candidate * _LEVELS + length % _LEVELS).cast("int")
    return kept.select(F.shiftright("here", NUMBER_BITS).alias("chunk"), mark.alias("mark"), "id")


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", *, fewest: int = FEWEST, longest: int = LONGEST) -> DataFrame:
    """Every phrase of 2 to `longest` words that occurs at least `fewest` times in the texts of a language.

    `lang, words, f, n, prefixes, suffixes, covered`: its words; how often it occurs; the words of the language; how often
    its first 1, 2, … words occur and its last 1, 2, … words; whether a longer phrase holds it at every occurrence.
    A NULL language is `und`, a NULL text is empty; other columns do not matter.
    """
    chunks = settled(token_chunks(docs, lang, text, longest), "chunks")
    add = lambda total, count: total + count
    totals = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), add)).alias("n"))
    groups = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("candidate", "group"))
    groups = groups.select(_here("candidate"), "lang", F.col("group.words").alias("word"), F.col("group.counts").alias("count"))
    kept = settled(_frequent(groups, ["lang", "word"], fewest), "frequent")
    none = F.array().cast("array<bigint>")
    phrases = kept.filter("f IS NOT NULL").select("lang", "id", F.array("word").alias("words"), "f", none.alias("prefixes"), none.alias("suffixes"))
    words = _marks(kept, 1)

    found: list[DataFrame] = []
    relation = chunks.select("chunk", "seen", F.lit(None).cast("binary").alias("at"), F.col("tokens").alias("candidate"))
    for length in range(2, longest + 1):
        if length == 2:
            groups = _word_pairs(chunks, words)
        else:
            marks = _marks(kept, length - 1)
            relation = settled(_occurrences(relation, words.unionByName(marks) if length == 3 else marks, length), "occurrences")
            groups = relation.select("chunk", F.posexplode(F.arrays_zip("a", "b", "counts")).alias("candidate", "group"))
            groups = groups.select(_here("candidate"), "group.a", "group.b", F.col("group.counts").alias("count"))
        kept = settled(_frequent(groups, ["a", "b"], fewest), "frequent")
        phrases = stage(_grown(kept.filter("f IS NOT NULL").select("id", "a", "b", "f"), phrases), "phrases")
        found.append(phrases)

    result = None
    for phrases, longer in zip(found, [*found[1:], None]):
        marked = phrases.withColumn("covered", F.lit(False))
        if longer is not None:
            # what occurs as often within a longer phrase does so within one that is longer by a word
            whole = [(c, F.element_at(fs, -1)) for c, fs in (("a", "prefixes"), ("b", "suffixes"))]
            covered = longer.select(F.inline(F.array(*[F.struct(F.col(c).alias("id"), (f <= F.col("f")).alias("all")) for c, f in whole])))
            covered = covered.filter("all").select("id").distinct().withColumn("is_covered", F.lit(True))
            marked = phrases.join(covered, "id", "left").withColumn("covered", F.coalesce("is_covered", F.lit(False)))
        marked = marked.select("lang", "words", "f", "prefixes", "suffixes", "covered")
        result = marked if result is None else result.unionByName(marked)
    return result.join(totals, "lang")


def _grown(counts: DataFrame, shorter: DataFrame) -> DataFrame:
    """The phrases that two overlapping ones make, with the counts of all their beginnings and ends."""
    first = shorter.select(
        F.col("id").alias("a"), "lang", F.col("words").alias("start"), F.concat("prefixes", F.array("f")).alias("prefixes")
    )
    last = shorter.select(
        F.col("id").alias("b"), F.element_at("words", -1).alias("end"), F.concat("suffixes", F.array("f")).alias("suffixes")
    )
    return counts.join(first, "a").join(last, "b").select(
        "lang", "id", F.concat("start", F.array("end")).alias("words"), "f", "prefixes", "suffixes", "a", "b"
    )


# --- scores ---


def collocations(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The best phrases of every language that no longer one covers: `lang, rank, phrase, a, l, r, n, score`.

    Cutting a phrase in two compares its count with those of the parts: floor(1000 * a * n / (l * r)), in exact
    decimals. The lowest cut counts, the shortest first part of equals. Ties in score go by count, then by phrase.
    """
    cut = F.expr(
        """array_min(transform(sequence(1, size(prefixes)), k -> named_struct(
          'score', (1000BD * cast(f AS decimal(15, 0)) * cast(n AS decimal(18, 0)))
            div (cast(prefixes[k - 1] AS decimal(15, 0)) * cast(suffixes[size(prefixes) - k] AS decimal(15, 0))),
          'k', k, 'l', prefixes[k - 1], 'r', suffixes[size(prefixes) - k])))"""
    )
    scored = phrases.filter(~F.col("covered")).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "n", cut.alias("cut")
    )
    scored = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of every language in all documents."""
    return collocations(frequent_phrases(table(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS place FROM worded
), sized AS (
  SELECT lang, words, place, unnest(range(1, least(5, len(words) - place + 1) + 1)) AS k FROM places
), grams AS (
  SELECT lang, k, words[place:place + k - 1] AS gram, count(*) AS f FROM sized GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM grams WHERE f >= 100
), cuts AS (
  SELECT g.lang, g.k, g.gram, g.f AS a, unnest(range(1, g.k)) AS cut FROM frequent g WHERE g.k > 1
), scored AS (
  SELECT c.lang, c.k, c.gram, c.a, c.cut, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN frequent x ON x.lang = c.lang AND x.gram = c.gram[1:c.cut]
  JOIN frequent y ON y.lang = c.lang AND y.gram = c.gram[c.cut + 1:c.k]
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) AS nth FROM scored
), inside AS (
  SELECT DISTINCT lang, gram[s:s + j - 1] AS gram, f FROM (
    SELECT lang, gram, f, k, j, unnest(range(1, k - j + 2)) AS s
    FROM (SELECT lang, gram, f, k, unnest(range(2, k)) AS j FROM frequent WHERE k > 2))
), ranked AS (
  SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, n, score FROM lowest
  WHERE nth = 1 AND NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = lowest.lang AND i.gram = lowest.gram AND 100 * i.f >= 100 * lowest.a)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
WHERE rank <= 2000
"""
