"""Chat formatting: the best branches of reply trees, each as one conversation.

A message answers its parent. Self-joins that double their steps each round walk from every message to
its root and add the scores up on the way, so that a path of n messages takes log2(n) joins; the
leaves of a tree are ranked by the score of their path; the same steps, taken back from long to short,
enumerate the messages of the chosen paths. Only numbers move in these joins. Texts are shuffled once, to
their tree, where the chosen ones are put in order and formatted.

A table of conversations is a set of trees of one branch: every row answers the row before it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import map_batches, stage, table

ASSISTANT = "assistant"
# The template: what the assistant says ends with END; any other turn is OPEN, its role, a line break, its text, CLOSE.
END = "</s>"
OPEN = "[INST] "
CLOSE = " [/INST]"
# Control strings, which a text must not hold unescaped. None begins with the end of itself or of another.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_HEADER = re.compile(r"\[INST\] ((?:[^\\\n]|\\.)*)\n", re.DOTALL)

Turn = tuple[str, str]
Span = tuple[int, int]


# --- the template ---


def escape(text: str) -> str:
    """A backslash is doubled, and one is put after the first character of every control string."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    """The inverse of `escape`: a backslash goes, and what it stands before stays."""
    return _ESCAPE.sub(r"\1", text)


def format_turns(turns: list[Turn]) -> tuple[str, list[Span]]:
    """The conversation, and the spans (code points, end exclusive) of what the assistant says: the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        said = escape(text)
        if role == ASSISTANT:
            spans.append((at, at + len(said)))
            part = said + END
        else:
            part = OPEN + escape(role).replace("\n", "\\\n") + "\n" + said + CLOSE
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        header = _HEADER.match(formatted, at)
        start, close = (header.end(), CLOSE) if header else (at, END)
        end = formatted.index(close, start)
        turns.append((unescape(header[1]) if header else ASSISTANT, unescape(formatted[start:end])))
        at = end + len(close)
    return turns


# --- trees ---


def as_messages(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as messages: `tree, conv_id, message, parent, role, text`.

    Rows are in the order of their turn, NULL first, then role and text; rows that agree in all of these are one message,
    which is said as often as it is there. A NULL id is a conversation of its own; NULL roles and texts are empty.
    """
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("tree"),
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", F.xxhash64("text"))
    numbered = rows.withColumn("message", F.dense_rank().over(order))
    parent = F.when(F.col("message") > 1, F.col("message") - 1)
    return numbered.select("tree", "conv_id", "message", parent.alias("parent"), "role", "text")


def best_branches(messages: DataFrame, score: str | None = None, branches: int = 1) -> DataFrame:
    """The best root-to-leaf paths of every tree: `tree, branch, score, path`.

    `messages` has `tree, message, parent`, where a message may be repeated; a parent that is NULL or not in
    the tree makes a root, and messages that lead into a circle have no path. A path's score is the sum of its messages' (NULL
    is 0; without `score` it is the number of messages); equal scores go by the leaf. `path` lists the messages from the root on.
    """
    worth = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(1.0)
    nodes = messages.groupBy("tree", "message").agg(F.min("parent").alias("up"), F.max(worth).alias("total"))
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n"))
    state = stage(nodes.join(sizes, "tree").withColumn("depth", F.lit(1)), "messages")

    levels: list[DataFrame] = []
    walked = [state.filter("up IS NULL")]  # messages that have reached their root
    leaves = None
    while True:
        step = len(levels)
        # a path has n messages at most and ends at NULL or a missing parent; what still goes on is in a circle
        going = state.filter(F.col("up").isNotNull() & (F.col("n") >= (1 << step)))
        if going.isEmpty():
            break
        above = state.select("tree", F.col("message").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("worth"))
        met = going.join(above.withColumn("found", F.lit(True)), ["tree", "up"], "left" if levels else "full_outer").select(
            "tree",
            "message",
            F.when(F.col("found"), F.col("up")).alias("via"),
            F.col("next").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            (F.col("total") + F.coalesce("worth", F.lit(0.0))).alias("total"),
            "n",
        )
        met = stage(met, "walked")
        if not levels:
            # messages that nobody answers
            leaves = met.filter("message IS NULL").select("tree", F.col("via").alias("message"))
        met = met.filter("message IS NOT NULL")
        levels.append(met.filter("via IS NOT NULL").select("tree", "message", "via"))
        moved = met.select("tree", "message", "up", "total", "n", "depth")
        # trees that are through take no part in later rounds
        left = F.col("n") >= (1 << (step + 1))
        state = moved.filter(left)
        for done in walked:
            state = state.unionByName(done.filter(left))
        walked.append(moved.filter("up IS NULL"))

    reached = walked[0].select("tree", "message", "depth", "total")
    for done in walked[1:]:
        reached = reached.unionByName(done.select("tree", "message", "depth", "total"))
    if leaves is not None:
        reached = reached.join(leaves, ["tree", "message"], "left_semi")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "message"))
    chosen = reached.withColumn("branch", rank).filter(F.col("branch") <= branches)

    path = chosen.select("tree", "branch", "message", F.col("depth").alias("place"), "total")
    for step in reversed(range(len(levels))):
        found = path.join(levels[step], ["tree", "message"], "left")
        itself = F.struct("message", "place")
        further = F.struct(F.col("via").alias("message"), (F.col("place") - (1 << step)).alias("place"))
        both = F.when(F.col("via").isNull(), F.array(itself)).otherwise(F.array(itself, further))
        path = found.select("tree", "branch", "total", F.inline(both))
    places = F.array_sort(F.collect_list(F.struct("place", "message")))
    return path.groupBy("tree", "branch", F.col("total").alias("score")).agg(F.transform(places, lambda p: p["message"]).alias("path"))


def conversations_of(messages: DataFrame, branches: DataFrame, keep: list[str]) -> DataFrame:
    """Each chosen path as one formatted conversation: `tree, branch, score, formatted, loss_spans` and the columns `keep` of a tree,
    whose names are none of these. Other columns of the messages are left out.

    The messages of a tree are sorted together in one task, where only those of its chosen paths are held.
    """
    said = messages.select("tree", "message", "role", "text", *keep).join(branches, "tree").withColumn("place", F.array_position("path", F.col("message")))
    turns = F.array_sort(F.collect_list(F.struct("place", "role", "text")))
    grouped = said.filter("place > 0").groupBy("tree", "branch", "score").agg(*[F.first(c).alias(c) for c in keep], turns.alias("turns"))
    kept = ["tree", "branch", "score", *keep]

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            laid = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
            spans = [[{"start": s, "end": e} for s, e in spans] for _, spans in laid]
            out = batch.select(kept)
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array([f for f, _ in laid], pa.string()), pa.array(spans, SPANS)], [*kept, "formatted", "loss_spans"]
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grouped.select(*kept).schema)
    return map_batches(grouped, lay_out, f"{columns}, formatted string, loss_spans array<struct<start: bigint, end: bigint>>")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


# --- the query ---

# A conversation of control strings alone, which the contract adds.
CONTROL_CONVERSATION = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", ASSISTANT))]


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns, and the text under the loss mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((len(turns), _sha256(said), len(loss), _sha256(loss), len(text)))
            columns = zip(*rows) if rows else [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_batches(formatted.select("conv_id", "formatted", "loss_spans"), read, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what is read back from them."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = as_messages(given.unionByName(spark.createDataFrame(CONTROL_CONVERSATION, given.schema)))
    return digests(conversations_of(messages, best_branches(messages), ["conv_id"]))


OP12_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|<s>|</s>|\[INST\]|\[/INST\]')) AS chars,
    length(role) + len(regexp_extract_all(role, '\\|<s>|</s>|\[INST\]|\[/INST\]|\n')) AS role_chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' THEN chars + 4 ELSE chars + role_chars + 16 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
