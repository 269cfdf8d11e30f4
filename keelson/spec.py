"""Table specification: everything the generic operators need to know
about one captured table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property
from typing import Sequence

from pyspark.sql import types as T

from keelson.operators.quality import Rule


@dataclass(frozen=True)
class TableSpec:
    name: str                          # logical table / topic suffix
    key: tuple[str, ...]               # business key inside the row image
    after_ddl: str                     # row image, e.g. "id bigint, status string"
    source_system: str = "source"      # literal lineage column
    # row-image fields that arrive as decimals: field -> (precision, scale);
    # encoded as base64 two's complement ("base64", the capture tool's precise
    # mode) or as plain numbers / numeric strings ("string")
    decimals: dict = field(default_factory=dict)
    decimal_encoding: str = "base64"
    # row-image fields sent as numbers since the epoch: field -> "micros" |
    # "millis" (-> timestamp_ntz) or "days" (-> date)
    temporal: dict = field(default_factory=dict)
    rules: Sequence[Rule] = ()
    # change order, latest last: (commit time, log position, transport time)
    order: tuple[str, ...] = ("source_ts_ms", "source_lsn", "kafka_timestamp")
    keep_before: bool = True           # parse the before image (deletes, diffs)
    # what identifies one change (a repeated delivery repeats all of these):
    # the log position when the source sends it, else commit time + tx + op
    change_id: tuple[str, ...] = ("source_lsn", "source_ts_ms", "source_tx_id", "cdc_operation")

    @cached_property
    def after_schema(self) -> T.StructType:
        """Parsed once per spec (DDL parsing goes through the JVM)."""
        return T.StructType.fromDDL(self.after_ddl)

    @cached_property
    def row_fields(self) -> list[str]:
        return [f.name for f in self.after_schema.fields]

    @cached_property
    def value_fields(self) -> list[str]:
        return [f for f in self.row_fields if f not in self.key]
