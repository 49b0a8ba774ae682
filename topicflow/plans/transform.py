"""The whole record transform, in its fixed order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.convert import decimals_to_double, lowercase_fields
from topicflow.operators.decode import (
    compact_json,
    decode_json,
    decode_xml,
    drop_tombstones,
    xml_to_json,
)
from topicflow.operators.declared import decode_declared
from topicflow.operators.evolve import align_to, merge_schemas
from topicflow.operators.explode import explode_container
from topicflow.operators.flatten import chunk_json, flatten
from topicflow.operators.mask import apply_mask
from topicflow.operators.metadata import embed_metadata
from topicflow.operators.validate import split_invalid, validate_keys, validate_widths
from topicflow.plans.options import Options
from topicflow.records import ENVELOPE, INVALID, add_reason

VALUE = "value"
RAW = "raw"


@dataclass(frozen=True)
class Transformed:
    valid: DataFrame  # envelope + struct column ``value``
    dead_letters: DataFrame  # envelope + original payload ``value`` + ``reason``
    schema: T.StructType  # of ``value``, evolved


def inference(options: Options) -> dict[str, bool]:
    """How schemas of payloads without one are inferred."""
    return {
        "discard_collections": options.discard_collections,
        "mixed": options.flatten and not options.explode,
    }


def _decode(
    df: DataFrame, options: Options, inferred: T.StructType | None
) -> tuple[DataFrame, bool]:
    """Struct column ``value``; the flag says whether rows had a declared schema."""
    if options.format == "struct":
        return df.withColumns({RAW: F.to_json(VALUE), INVALID: F.array().cast("array<string>")}), True
    df = df.withColumn(RAW, F.col(VALUE))
    if options.format == "json_envelope":
        return decode_declared(df), True
    if options.json_chunks is not None and options.schema is None:
        # cut the payload itself: no inference, any keys
        text = F.col(VALUE).cast("string")
        text = xml_to_json(text) if options.format == "xml" else compact_json(text)
        df = df.withColumn(VALUE, text)
        return add_reason(df, F.when(F.col(VALUE).isNull(), F.lit("malformed payload"))), False
    how = inference(options)
    if options.format == "xml":
        return decode_xml(df, options.schema, **how), False
    return decode_json(df, inferred if options.schema is None else options.schema, **how), options.schema is not None


def shape_record(df: DataFrame, options: Options) -> DataFrame:
    """Flatten or chunk ``value`` and add lineage to it."""
    if options.json_chunks is not None:
        df = chunk_json(df, options.json_chunks, options.varchar_length, VALUE)
    elif options.flatten:
        df = flatten(df, VALUE, options.discard_collections)
    if options.embed_metadata or options.embedded_order:
        df = embed_metadata(df, VALUE, options.embed_metadata, options.embedded_order)
    return df


def transform_rows(
    df: DataFrame,
    options: Options,
    known: T.StructType | None = None,
    inferred: T.StructType | None = None,
) -> tuple[DataFrame, T.StructType]:
    """Envelope, ``value``, ``raw`` payload and ``_invalid`` reasons, not yet split.

    Order: decode, convert, flatten, lineage, evolve and align, mask, check
    keys, check widths.  Masking and keys therefore see flattened names and lineage columns.
    With ``explode`` the record keeps its shape here, see ``explode_rows``.
    ``inferred`` is the schema of the payloads where it was inferred before.
    """
    df, declared = _decode(drop_tombstones(df), options, inferred)
    if declared:
        if options.decimals_to_double:
            df = decimals_to_double(df, VALUE)
        if options.lowercase:
            df = lowercase_fields(df, VALUE)
    if not options.explode:
        df = shape_record(df, options)
    schema = df.schema[VALUE].dataType
    if known is not None:
        schema = merge_schemas(known, schema)
        df = align_to(df, schema, VALUE)
    if options.mask is not None:
        df = apply_mask(df, options.mask, VALUE)
    df = validate_keys(df, list(options.keys), options.allow_null_keys, VALUE)
    if options.varchar_length is not None and options.json_chunks is None and not options.explode:
        # the target's text columns are that wide; chunks are cut to fit
        df = validate_widths(df, options.varchar_length, VALUE)
    return df.select(*ENVELOPE, VALUE, RAW, INVALID), schema


def split_rows(df: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    valid, dead = split_invalid(df, options.continue_on_invalid)
    originals = dead.select(*ENVELOPE, F.col(RAW).alias(VALUE), "reason")
    return valid.drop(RAW), originals


def transform(df: DataFrame, options: Options, known: T.StructType | None = None) -> Transformed:
    """Topic rows to clean records; ``known`` is the schema evolved so far."""
    rows, schema = transform_rows(df, options, known)
    valid, dead = split_rows(rows, options)
    return Transformed(valid, dead, schema)


def explode_rows(df: DataFrame, options: Options) -> DataFrame:
    """Row generator for list containers; runs after segmentation, so that a
    segment counts containers."""
    if not options.explode:
        return df
    return shape_record(explode_container(df, VALUE), options)
