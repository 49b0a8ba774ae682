"""Nested record to one column per leaf, or to fixed-width JSON chunks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.records import at, record_schema, reject_collisions, with_record

KEEP_NULLS = {"ignoreNullFields": "false"}


def flat_name(path: Iterable[str]) -> str:
    # an empty step stands for the plain value of a field that is an object
    # in other rows, so it adds nothing to the name
    return re.sub(r"[^a-zA-Z0-9]", "_", "_".join(p for p in path if p))


def leaves(
    schema: T.StructType, discard_collections: bool = False, prefix: tuple[str, ...] = ()
) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    """(path, type) of every leaf, depth first in field order."""
    for field in schema:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaves(field.dataType, discard_collections, path)
        elif not (discard_collections and isinstance(field.dataType, (T.ArrayType, T.MapType))):
            yield path, field.dataType


def _json_item(c: Column) -> Column:
    """JSON text of one value: a one-element array without its brackets."""
    text = F.to_json(F.array(c), KEEP_NULLS)
    return F.substring(text, F.lit(2), F.length(text) - 2)


def collection_json(c: Column, dtype: T.DataType) -> Column:
    """Compact JSON text; maps without text keys become ``[[key,value],…]``."""
    if isinstance(dtype, T.MapType) and not isinstance(dtype.keyType, T.StringType):
        pairs = F.transform(
            F.map_entries(c),
            lambda e: F.concat(
                F.lit("["), _json_item(e["key"]), F.lit(","), _json_item(e["value"]), F.lit("]")
            ),
        )
        return F.when(
            c.isNotNull(), F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]"))
        )
    return F.to_json(c, KEEP_NULLS)


def flatten(
    df: DataFrame,
    column: str | None = None,
    discard_collections: bool = False,
    keep: Iterable[str] = (),
) -> DataFrame:
    """One column per leaf, named by its path joined with ``_``.

    Lists and maps become JSON text or, with ``discard_collections``, are left
    out.  ``keep`` passes columns through untouched when the record is the row.
    """
    keep = tuple(keep)
    schema = record_schema(df, column)
    if column is None:
        schema = T.StructType([f for f in schema if f.name not in keep])
    found = list(leaves(schema, discard_collections))
    reject_collisions(
        [(k, k) for k in keep] + [(".".join(path), flat_name(path)) for path, _ in found]
    )
    fields = []
    for path, dtype in found:
        c = at(column, path)
        if isinstance(dtype, (T.ArrayType, T.MapType)):
            c = collection_json(c, dtype)
        fields.append((flat_name(path), c))
    return with_record(df, column, fields, keep)


def chunk_json(
    df: DataFrame,
    chunks: int,
    length: int,
    column: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """The whole record as JSON, cut into ``chunks`` columns of ``length`` bytes.

    A text column is cut as it is.  The cut is by byte, so a character on the
    border turns into replacement characters on both sides.  A record that
    needs more chunks fails the job: nothing is ever cut off.
    """
    if chunks < 1 or length < 1:
        raise ValueError("chunks and length must be at least 1")
    keep = tuple(keep)
    if column is None:
        names = [c for c in df.columns if c not in keep]
        text = F.to_json(F.struct(*[at(None, [n]) for n in names]), KEEP_NULLS)
    elif isinstance(df.schema[column].dataType, (T.StringType, T.BinaryType)):
        text = at(column, ())
    else:
        text = F.to_json(at(column, ()), KEEP_NULLS)
    blob = text.cast("binary")
    size = F.octet_length(blob)
    fits = F.when(
        size > chunks * length,
        F.raise_error(
            F.format_string(
                f"{chunks} chunks of {length} bytes cannot hold a record of %d bytes", size
            )
        ).cast("binary"),
    ).otherwise(blob)
    fields = []
    for i in range(chunks):
        start = i * length
        piece = F.make_valid_utf8(F.substring(fits, start + 1, length).cast("string"))
        fields.append((f"payload_chunk{i + 1}", F.when(size > start, piece)))
    return with_record(df, column, fields, keep)
