"""Chat formatting against plain Python, and exact round trips."""

import hashlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import chat

FIXTURE = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.lists(st.sampled_from([*chat.CONTROL, "\\", "[", "<", "/", "s>", "INST]", " ", "\n", "é", "ok", "\U0001f600"]), max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_turns_come_back_and_the_mask_holds_what_the_assistant_says(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.read_turns(formatted) == turns
    assert [chat.unescape(formatted[s:e]) for s, e in spans] == [t for r, t in turns if r == chat.ASSISTANT]
    for role, text in turns:
        assert not any(c in chat.escape(text) for c in chat.CONTROL) and chat.unescape(chat.escape(text)) == text


def slow_branches(rows, best):
    """Paths by walking up from every leaf."""
    found = []
    for tree in {r[0] for r in rows}:
        up = {m: p for t, m, p, _ in rows if t == tree}
        score = {m: s or 0 for t, m, _, s in rows if t == tree}
        paths = []
        for leaf in set(up) - set(up.values()):
            path, at = [leaf], leaf
            while up[at] in up and up[at] not in path:
                at = up[at]
                path.append(at)
            if up[at] not in path:
                paths.append((-sum(score[m] for m in path), leaf, path[::-1]))
        found += [(tree, n, -s, tuple(p)) for n, (s, _, p) in enumerate(sorted(paths)[:best], 1)]
    return sorted(found)


NODES = st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 14), st.one_of(st.none(), st.integers(1, 16)), st.one_of(st.none(), st.integers(-2, 3))),
                 min_size=1, max_size=24, unique_by=lambda r: r[:2])


@FIXTURE
@given(NODES, st.integers(1, 3))
def test_branches_of_any_trees(spark, data, best):
    """Several roots, missing parents, ties, circles and messages that lead into them."""
    df = spark.createDataFrame(data, "tree string, message int, parent int, score int")
    found = sorted((r.tree, r.branch, int(r.score), tuple(r.path)) for r in chat.best_branches(df, "score", best).collect())
    assert found == slow_branches(data, best)


def test_a_long_thread_beside_a_bush_and_lone_messages(spark):
    data = [("long", n, n - 1, 1) for n in range(1, 300)] + [("long", 1000 + n, 150, 2) for n in range(50)]
    data += [("bush", 0, None, 0)] + [("bush", n, 0, n % 7) for n in range(1, 200)] + [("lone", 5, None, None), ("orphan", 5, 77, 3)]
    df = spark.createDataFrame(data, "tree string, message int, parent int, score int")
    found = sorted((r.tree, r.branch, int(r.score), tuple(r.path)) for r in chat.best_branches(df, "score", 2).collect())
    assert found == slow_branches(data, 2)
    repeated = chat.best_branches(df.unionByName(df), "score", 2)
    assert sorted((r.tree, r.branch, int(r.score), tuple(r.path)) for r in repeated.collect()) == found


def test_trees_become_conversations(spark):
    rows = [(1, None, "user", "hi", 0.0), (2, 1, "assistant", "bad", 0.1), (3, 1, "assistant", "good </s>", 0.9), (4, 3, "user", "", 0.0), (5, 2, "user", "why", 0.2)]
    messages = spark.createDataFrame([("t", *r) for r in rows], "tree string, message int, parent int, role string, text string, score double")
    made = chat.conversations_of(messages, chat.best_branches(messages, "score", 2), [])
    found = {r.branch: (round(r.score, 3), chat.read_turns(r.formatted)) for r in made.collect()}
    assert found == {
        1: (0.9, [("user", "hi"), ("assistant", "good </s>"), ("user", "")]),
        2: (0.3, [("user", "hi"), ("assistant", "bad"), ("user", "why")]),
    }


def slow_digests(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_odd_rows(spark):
    """NULLs in every column, repeated rows, equal turns of several roles, a long text, other columns."""
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None), (1, 2, None, "x"), (None, 0, "assistant", "n"), (None, 1, "user", "\\[INST]"),
            (2, 5, "assistant", "é" * 300_000), (3, 1, "assistant", "one"), (3, 1, "assistant", "one"), (4, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"tree": F.lit(1), "message": F.lit("m"), "formatted": F.lit(0)})
    messages = chat.as_messages(df)
    found = chat.digests(chat.conversations_of(messages, chat.best_branches(messages), ["conv_id"]))
    assert {r.conv_id: tuple(r)[1:5] for r in found.collect()} == slow_digests(rows)
    empty = chat.as_messages(df.filter("false"))
    assert chat.digests(chat.conversations_of(empty, chat.best_branches(empty), ["conv_id"])).count() == 0
