"""Column names, control columns, casts and defaults."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.dates import moment
from tradeloom.functions.text import repair_encoding

# Fixed names: the five columns that every ingested table carries.
CONTROL_COLUMNS = ["ingestion_timestamp", "source_system", "source_table", "batch_id", "load_type"]

# A word starts at a capital that follows a lower-case letter or digit, or at the last
# capital of a run that is followed by a lower-case letter: Invoice|ID, HTTP|Server.
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])")


def new_batch_id(now: datetime | None = None) -> str:
    """yyyyMMddHHmmss in UTC, a dash and eight hex digits."""
    moment = now or datetime.now(timezone.utc)
    return moment.strftime("%Y%m%d%H%M%S") + "-" + uuid.uuid4().hex[:8]


def add_control_columns(
    df: DataFrame,
    source_system: str,
    source_table: str,
    batch_id: str,
    load_type: str,
    ingested_at: datetime | Column | None = None,
) -> DataFrame:
    """Stamp every row with one instant, its origin and its batch."""
    stamp = moment(datetime.now(timezone.utc) if ingested_at is None else ingested_at)
    values = [stamp, source_system, source_table, batch_id, load_type]
    return df.withColumns(
        {name: value if isinstance(value, Column) else F.lit(value) for name, value in zip(CONTROL_COLUMNS, values)}
    )


def drop_control_columns(df: DataFrame) -> DataFrame:
    return df.drop(*CONTROL_COLUMNS)


def snake_case(name: str) -> str:
    """PascalCase to snake_case with acronyms kept whole: InvoiceID -> invoice_id."""
    return _WORD_START.sub("_", name).lower()


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to snake_case in one projection; two that fall together are an error."""
    names = {name: snake_case(name) for name in df.columns}
    if len(set(names.values())) < len(names):
        raise ValueError(f"column names collide in snake_case: {sorted(names)}")
    return df.withColumnsRenamed(names)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that exist; a value that cannot be cast becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs per column, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()})


def repair_text_columns(
    df: DataFrame, columns: list[str], updated_at: str, repaired_at: datetime | Column | None = None
) -> DataFrame:
    """Repair misread text and move `updated_at` of the rows that changed.

    The new time is what lets the next incremental load pick the repaired rows up.
    """
    changed = F.lit(False)
    for column in columns:
        changed = changed | ~repair_encoding(column).eqNullSafe(F.col(column))
    fixed = {c: repair_encoding(c) for c in columns}
    fixed[updated_at] = F.when(changed, moment(repaired_at).cast(df.schema[updated_at].dataType)).otherwise(F.col(updated_at))
    return df.withColumns(fixed)
