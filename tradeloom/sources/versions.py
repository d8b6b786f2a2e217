"""Versions of a layer: the tables of one refresh, published together in one step.

A refresh writes its tables to <root>/<layer>/_versions/<version>/<table>. The version
counts from the moment at which an empty file of its name appears in <root>/<layer>/_published;
creating that file is the only step, so a refresh that stops anywhere leaves readers the
version before, whole. Readers take the highest name that is published and keep to it. A layer
without a published version, such as bronze, has its tables in its own folder.

One refresh of a layer runs at a time. The version before the newest is kept, for readers that began with it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold", "diamond")
VERSIONS = "_versions"
PUBLISHED = "_published"
TOTALS = "totals.json"
KEPT_VERSIONS = 2

# Column that splits an upserted table by key; every split is rewritten as a whole.
KEY_RANGE = "key_range"


def layer_path(root: str, layer: str) -> str:
    """<root>/<layer>; joined as text, which keeps s3a:// and the like intact."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer!r}")
    return f"{root.rstrip('/')}/{layer}"


@dataclass(frozen=True)
class LayerVersion:
    """The tables of a layer as one refresh left them; `name` is None for a layer without versions."""

    root: str
    layer: str
    name: str | None = None

    @property
    def folder(self) -> str:
        base = layer_path(self.root, self.layer)
        return base if self.name is None else f"{base}/{VERSIONS}/{self.name}"

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        df = spark.read.parquet(self.path(table))
        return df.drop(KEY_RANGE) if KEY_RANGE in df.columns else df

    def totals(self, spark: SparkSession) -> dict[str, dict[str, object]]:
        """What was counted and added up per table while this version was written; empty if nothing was."""
        text = read_text(spark, f"{self.folder}/{TOTALS}")
        return json.loads(text) if text else {}


def published_versions(spark: SparkSession, root: str, layer: str) -> list[str]:
    """The names of the published versions, oldest first."""
    return file_names(spark, f"{layer_path(root, layer)}/{PUBLISHED}")


def current_version(spark: SparkSession, root: str, layer: str) -> LayerVersion:
    """What a reader of the layer sees. Use one version for all tables that belong together."""
    names = published_versions(spark, root, layer)
    return LayerVersion(root, layer, names[-1] if names else None)


def next_version(spark: SparkSession, root: str, layer: str) -> LayerVersion:
    """A new version to write tables into, which nobody reads before it is published."""
    names = published_versions(spark, root, layer)
    number = int(names[-1].split("-")[0]) + 1 if names else 1
    return LayerVersion(root, layer, f"{number:010d}-{uuid.uuid4().hex[:8]}")


def publish_version(spark: SparkSession, version: LayerVersion, totals: Mapping[str, Mapping[str, object]]) -> None:
    """Make a version, with all its tables written, the one that readers see."""
    write_text(spark, f"{version.folder}/{TOTALS}", json.dumps(totals, default=str, sort_keys=True))
    files, mark = _files(spark, f"{layer_path(version.root, version.layer)}/{PUBLISHED}/{version.name}")
    if not files.createNewFile(mark):
        raise OSError(f"{mark} exists already")


def drop_old_versions(spark: SparkSession, root: str, layer: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete all but the newest published versions, and what refreshes that stopped have left."""
    names = published_versions(spark, root, layer)
    kept = names[-keep:]
    base = layer_path(root, layer)
    for name in file_names(spark, f"{base}/{VERSIONS}"):
        # a higher number than the newest belongs to a refresh that is running
        if name not in kept and kept and name.split("-")[0] <= kept[-1].split("-")[0]:
            _delete(spark, f"{base}/{VERSIONS}/{name}")
    # the marks go last and oldest first, so that the newest is always there
    for name in names[:-keep]:
        _delete(spark, f"{base}/{PUBLISHED}/{name}")


# --- small files, through Spark's own file systems ---


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _delete(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    files, place = _files(spark, folder)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str | None:
    files, place = _files(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: readers find all of it or nothing."""
    files, place = _files(spark, path)
    unfinished = _files(spark, f"{path}.{uuid.uuid4().hex}.unfinished")[1]
    stream = files.create(unfinished)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not files.rename(unfinished, place):
        files.delete(unfinished, False)
        raise OSError(f"cannot write {path}")


def without_unfinished(names: Iterable[str]) -> list[str]:
    return [n for n in names if not n.endswith(".unfinished")]
