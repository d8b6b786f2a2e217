"""The batches of every bronze table: one small file for each, written when all else of the batch is done.

<root>/bronze/_ledger/<table>/<number>-<batch> says up to which time the table holds the source and how
many rows came. A batch that died before its file was written is simply run again: it starts from
the mark of the batch before, finds the same rows, and the upsert puts them where they are. A batch that
is in the ledger is not run again. The next mark is read here, not from the table.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import SparkSession

from tradeloom.sources.versions import file_names, layer_path, read_text, without_unfinished, write_text

LEDGER = "_ledger"


@dataclass(frozen=True)
class Batch:
    """A finished batch: the high-water mark after it (None: nothing yet, or a full load) and its rows."""

    batch_id: str
    load_type: str
    rows: int
    mark: datetime | None = None


class Ledger:
    """The batches of one table, oldest first. One ingest of a table runs at a time."""

    def __init__(self, spark: SparkSession, root: str, table: str) -> None:
        self.spark = spark
        self.folder = f"{layer_path(root, 'bronze')}/{LEDGER}/{table}"

    def names(self) -> list[str]:
        return without_unfinished(file_names(self.spark, self.folder))

    def last(self) -> Batch | None:
        names = self.names()
        return self._read(names[-1]) if names else None

    def find(self, batch_id: str) -> Batch | None:
        """The batch, if it was finished."""
        own = [n for n in self.names() if n.partition("-")[2] == _file_name(batch_id)]
        return self._read(own[-1]) if own else None

    def add(self, batch: Batch) -> None:
        names = self.names()
        number = int(names[-1].partition("-")[0]) + 1 if names else 1
        entry = asdict(batch) | {"mark": batch.mark.isoformat() if batch.mark else None}
        write_text(self.spark, f"{self.folder}/{number:010d}-{_file_name(batch.batch_id)}", json.dumps(entry, sort_keys=True))

    def _read(self, name: str) -> Batch:
        entry = json.loads(read_text(self.spark, f"{self.folder}/{name}"))
        mark = entry["mark"]
        return Batch(**entry | {"mark": datetime.fromisoformat(mark) if mark else None})


def _file_name(batch_id: str) -> str:
    return quote(batch_id, safe="")
