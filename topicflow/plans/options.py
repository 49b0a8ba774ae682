"""What a user can choose, checked before any job runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from topicflow.operators.mask import Mask
from topicflow.operators.metadata import order_column_for
from topicflow.operators.segment import millis
from topicflow.operators.validate import check_key_names

FORMATS = ("json", "json_envelope", "xml", "struct")


@dataclass(frozen=True)
class Options:
    table: str = "topic_rows"
    format: str = "json"
    schema: T.StructType | None = None
    # every topic evolves schemas of its own, and topics never share a table
    schema_per_topic: bool = False
    # shape
    flatten: bool = True
    discard_collections: bool = False
    json_chunks: int | None = None
    varchar_length: int | None = None
    decimals_to_double: bool = False
    lowercase: bool = False
    explode: bool = False
    embed_metadata: bool = True
    mask: Mask | None = None
    # keys
    keys: tuple[str, ...] = ()
    allow_null_keys: bool = False
    order_by: str | None = None
    # keyed tables are rewritten by bucket: about as many as fit a task's memory each
    buckets: int = 64
    # invalid rows
    continue_on_invalid: bool = False
    # segments
    max_records: int | None = None
    max_bytes: int | None = None
    idle: str | int | None = None
    row_group_bytes: int | None = None

    def __post_init__(self) -> None:
        if not self.table.strip():
            raise ValueError("table must not be empty")
        if self.format not in FORMATS:
            raise ValueError(f"format must be one of {', '.join(FORMATS)}")
        keys = self.keys.split(",") if isinstance(self.keys, str) else self.keys
        object.__setattr__(self, "keys", tuple(k.strip() for k in keys if k.strip()))
        check_key_names(self.keys)
        if not self.flatten and self.discard_collections:
            raise ValueError("discard_collections needs flatten")
        if not self.flatten and self.json_chunks is not None:
            raise ValueError("json_chunks needs flatten")
        if self.json_chunks is not None and self.varchar_length is None:
            raise ValueError("json_chunks needs varchar_length")
        if self.json_chunks is not None and self.json_chunks < 1:
            raise ValueError("json_chunks must be at least 1")
        if self.varchar_length is not None and not 1 <= self.varchar_length <= 65000:
            raise ValueError("varchar_length must be between 1 and 65000")
        if self.max_bytes is not None and self.max_bytes < 100_000:
            raise ValueError("max_bytes must be at least 100000")
        if self.max_records is not None and self.max_records < 1:
            raise ValueError("max_records must be greater than 0")
        if self.idle is not None and millis(self.idle) <= 1000:
            raise ValueError("idle must be more than 1000 ms")
        if not 1 <= self.buckets <= 100_000:
            raise ValueError("buckets must be between 1 and 100000")
        if self.row_group_bytes is not None and self.row_group_bytes < 1:
            raise ValueError("row_group_bytes must be at least 1")

    @property
    def order_column(self) -> str | None:
        """Column that decides between rows with one key; None without keys."""
        return order_column_for(list(self.keys), self.order_by)

    @property
    def embedded_order(self) -> str | None:
        """The order column this package adds itself."""
        return self.order_column if self.keys and not self.order_by else None
