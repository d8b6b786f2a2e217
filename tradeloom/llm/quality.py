"""Quality by compression: a text compresses better with the dictionary of its own kind.

Two zstandard dictionaries are built, from good and from bad labelled texts. The difference
of the compressed sizes per byte, calibrated by a logistic curve, is the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import doc_fold, map_batches, table

# Rows of each class that are learned from: three quarters make its dictionary, the others the curve.
SAMPLE_ROWS = 3000
# Texts are compressed in consecutive pieces of at most so many bytes, so that what a dictionary saves
# per byte does not depend on a text's length: within a long text its own words would take the dictionary's place.
PIECE_BYTES = 2000
DICTIONARY_BYTES = 256 * 1024
LEVEL = 3
# Bytes of the stretches that a dictionary is made of, and of the strings that are counted to choose them. With them stated
# zstandard counts in all samples; left to search for its own it holds back a quarter and may end at a few kilobytes.
STRETCH_BYTES, COUNTED_BYTES = 200, 8
# Fixed by the contract.
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3


def dictionary(texts: list[str]) -> bytes:
    """What texts of this kind have often: all of their pieces if these fit, else what zstandard chooses from all."""
    samples = [piece for text in texts for piece in pieces(text)]
    whole = b"\n".join(samples)
    if len(whole) <= DICTIONARY_BYTES:
        return whole
    trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=STRETCH_BYTES, d=COUNTED_BYTES, split_point=1.0)
    return trained.as_bytes()


def pieces(text: str | None) -> list[bytes]:
    """The whole text in consecutive pieces of nearly equal size."""
    data = (text or "").encode("utf-8", "replace")
    n = -(-len(data) // PIECE_BYTES)
    return [data[len(data) * i // n : len(data) * (i + 1) // n] for i in range(n)]


@dataclass(frozen=True)
class Model:
    """Both dictionaries and the curve; without text of both kinds a constant score."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


class Scorer:
    """Scores texts; keeps the digested dictionaries."""

    def __init__(self, model: Model):
        self.model = model
        self.compressors = [self._compressor(d) for d in (model.good, model.bad)] if model.good and model.bad else []

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)

    def difference(self, text: str | None) -> float:
        """Bytes per byte of the whole text that the good dictionary saves over the bad one; 0 for no text."""
        parts = pieces(text)
        if not parts or not self.compressors:
            return 0.0
        good, bad = (sum(len(c.compress(p)) for p in parts) for c in self.compressors)
        return (bad - good) / sum(map(len, parts))

    def score(self, text: str | None) -> float:
        return float(curve(self.difference(text), self.model.slope, self.model.offset))


def curve(x, slope: float, offset: float):
    return 1.0 / (1.0 + np.exp(-np.clip(slope * x + offset, -40, 40)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Weighted logistic regression on one variable by Newton's method, with a light ridge."""
    slope, offset = 0.0, 0.0
    spread = max(float(np.std(x)), 1e-6)
    z = x / spread
    for _ in range(steps):
        p = curve(z, slope, offset)
        w = weight * np.maximum(p * (1 - p), 1e-9)
        g = np.array([(weight * (y - p) * z).sum() - 1e-3 * slope, (weight * (y - p)).sum() - 1e-3 * offset])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = slope + move[0], offset + move[1]
    return slope / spread, offset


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled rows that are not held out.

    Up to `sample_rows` rows of each class are chosen by a hash of their id, of both classes as
    many: three quarters make the dictionaries, the others the curve, weighted to the classes'
    share of all labels. Their texts are taken whole; the driver holds them.
    Labels other than 0 and 1, and rows without text, are left out.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & (doc_fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = known.select("doc_id", F.col("quality").alias("_label")).distinct()
    share = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if set(share) != {0, 1}:
        return Model(b"", b"", 0.0, 40.0 if share.get(1) else -40.0 if share.get(0) else 0.0)
    spot = F.xxhash64("doc_id")
    rows_each = min(sample_rows, *share.values())
    chosen = [
        known.filter(F.col("_label") == label).withColumn("_spot", spot).orderBy("_spot", "doc_id").limit(rows_each)
        for label in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1])
    texts = (
        documents.select("doc_id", "text")
        .filter(F.length("text") > 0)
        .join(F.broadcast(chosen), "doc_id")  # at most 2 * sample_rows ids
    )
    rows = texts.groupBy("doc_id", "_label", "_spot").agg(F.min("text").alias("text")).orderBy("_spot", "doc_id").collect()
    texts_of = {label: [r["text"] for r in rows if r["_label"] == label] for label in (0, 1)}
    if not all(len(t) > 1 for t in texts_of.values()):
        return Model(b"", b"", 0.0, float(np.log(share[1] / share[0])))
    apart = {label: max(1, len(t) // 4) for label, t in texts_of.items()}
    good, bad = (dictionary(texts_of[label][apart[label] :]) for label in (1, 0))
    scorer = Scorer(Model(good, bad, 0.0, 0.0))
    x = {label: np.array([scorer.difference(t) for t in texts_of[label][: apart[label]]]) for label in (0, 1)}
    weight = np.concatenate([np.full(len(x[label]), share[label] / sum(share.values()) / len(x[label])) for label in (0, 1)])
    y = np.concatenate([np.full(len(x[label]), float(label)) for label in (0, 1)])
    slope, offset = calibrate(np.concatenate([x[0], x[1]]), y, weight * len(y))
    return Model(good, bad, float(slope), float(offset))


def score_rows(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `score`, from 0 to 1, of every row's whole text, keeping `keep` (all columns).

    NULL and empty texts get the score of a text that neither dictionary favours. A column
    named `score` is replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c != "score"]
    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = pa.array([scorer.score(t) for t in batch.column("_text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], scores], names=[*kept, "score"])

    return map_batches(df.select(*kept, F.col(text).alias("_text")), run, f"{schema}score double")


def keep_good(df: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows whose text scores at least the threshold, with all their columns."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) >= threshold for t in batch.column(text).to_pylist()], pa.bool_()))

    return map_batches(df, run, schema)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by dictionaries of the labelled ones that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(documents, table(spark, sf_dir, "labels"))
    return score_rows(documents, model, keep=["doc_id"]).select(
        "doc_id",
        (doc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
