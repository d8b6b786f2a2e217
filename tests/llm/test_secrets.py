"""Secret spans against the plain patterns, and what the field adds on made-up cases."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from tradeloom.llm import secrets
from tradeloom.llm.secrets import OUTSIDE, Field, made_up_secret, op3_secret_scans, scan, train

SF = "/root/testdata/sf0.01"
LETTERS = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)
    for name in ("password", "passwd", "secret", "token", "apikey", "api_key")
)
PATTERNS = [
    ("assign", re.compile(f"({LETTERS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def plain_base(text):
    found = [(m.start(), k, m.end()) for k, (_, p, fits) in enumerate(PATTERNS) for m in p.finditer(text) if fits(m)]
    return [f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


@pytest.fixture(scope="module")
def found(spark):
    return op3_secret_scans(spark, SF).collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def field(texts):
    return train([t[:600] for i, t in sorted(texts.items()) if i % 3 == 0])


def test_base_spans_are_those_of_the_patterns(found, texts):
    assert len(found) == len(texts)
    for r in found:
        base = plain_base(texts[r.doc_id])
        kept = [s for s in r.spans.split(",") if s and not s.startswith("crf")]
        assert kept == base and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k, *_ in PATTERNS]


def test_clean_documents_gain_few_spans(found, texts):
    clean = [r for r in found if not plain_base(texts[r.doc_id])]
    assert sum(r.n_crf > 0 for r in clean) <= 0.01 * len(clean)


def test_the_field_finds_planted_secrets_that_no_pattern_knows(field, texts):
    rng = random.Random(99)
    scanner, hits, tries = secrets.Scanner(field), 0, 0
    for i, text in sorted(texts.items()):
        if i % 3 != 1 or plain_base(text):
            continue
        words = text.split(" ")
        at = rng.randrange(len(words) + 1)
        secret = made_up_secret(rng)
        before = " ".join([*words[:at], "credential = "]).removeprefix(" ")
        planted = f'{before}"{secret}" ' + " ".join(words[at:])
        if plain_base(planted):
            continue
        tries += 1
        start = len(before) + 1
        hits += any(a < start + len(secret) and start < b for a, b, _ in scanner.spans(planted))
    assert tries > 50 and hits >= 0.9 * tries


def test_viterbi_is_the_best_of_all_taggings():
    from itertools import product

    rng = np.random.default_rng(3)
    for first in (True, False):
        field = Field(np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3), frozenset())
        scores = rng.normal(size=(5, 3))

        def value(tags, field=field, scores=scores, first=first):
            total = (field.start if first else field.moves[OUTSIDE])[tags[0]] + scores[0, tags[0]]
            return total + sum(field.moves[a, b] + scores[t, b] for t, (a, b) in enumerate(zip(tags, tags[1:]), 1))

        assert tuple(field.viterbi(scores, first)) == max(product(range(3), repeat=5), key=value)


def test_skipped_words_are_outside_on_the_best_path(field, texts):
    """Decoding only the runs that may hold a secret equals decoding the whole text."""
    scanner = secrets.Scanner(field)
    for text in [*list(texts.values())[:150], 'token = "a1b2c3d4e5f6" x key: zZ9/8yT7+qWe12rT', "abc", '"Ab3dEf6hIj9Kl"']:
        words = secrets.WORDS.findall(text)
        if not words:
            continue
        tags = field.viterbi(scanner.scores(words), True)
        places = [m.span() for m in secrets.WORDS.finditer(text)]
        whole = {t for t in range(len(words)) if tags[t] != OUTSIDE}
        some = {t for t, (a, b) in enumerate(places) for s, e in scanner.tagged(text) if a < max(e, s + 1) and s < b}
        assert whole == some


def test_odd_rows(spark, field):
    rows = [(1, None, "a"), (2, "", None), (3, "password: token: abcdefgh", "b"), (3, "TOKEN=x token='abcdef'", "b"),
            (None, "é " * 3 + "AKIA" + "A" * 16, "c"), (5, "AKIAAKIA1234", "c"), (6, "w" * 300_000 + " " + "0" * 50, "d"), (7, "K" * 30, "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, starts string")
    found = scan(df, field).collect()
    assert len(found) == len(rows) and found[0].asDict().keys() == {"doc_id", "text", "starts", "ends", "kinds"}
    for r in found:
        base = [f"{k}:{a}:{b}" for k, a, b in zip(r.kinds, r.starts, r.ends) if k != "crf"]
        assert base == plain_base(r.text or "")
    assert scan(df.limit(0), field).collect() == []


def test_training_without_texts():
    assert secrets.Scanner(train([])).spans("nothing here") == []
    empty = secrets.fit([], frozenset())
    assert secrets.Scanner(empty).spans("token = abcdef1") == [(0, 15, 0)]


def test_shape_of_the_whole_word():
    head = "a" * 300
    for tail in ("@x.y.z", "0123456789" * 200, "{}[]" * 100):
        assert secrets.shape_features(head + tail) != secrets.shape_features(head)


def test_words_of_marks_take_linear_time():
    word = "x" + "." * 1_000_000 + "x"
    start = time.perf_counter()
    assert secrets.core_of(word) == (0, len(word))
    secrets.shape_features(word)
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("word, core", [
    ("plain", "plain"), ('"quoted",', "quoted"), ("key='abc';", "abc"), ("(api_key:abc)", "abc"), ("...", "..."), ("a=", "a="), ("x..y..", "x..y"),
])
def test_cores(word, core):
    start, end = secrets.core_of(word)
    assert word[start:end] == core
