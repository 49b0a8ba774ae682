"""Keyed tables in buckets: a batch rewrites the buckets it has keys of, and no others.

    data/batch=N/__bucket=B     the rows of bucket B as of batch N, one file
    snapshots/N.json            for every bucket the batch that holds its rows

A key's bucket is a hash of its text, so it does not move when a number column widens.
Reading a snapshot opens one folder per bucket in use.  Superseded folders go once no kept
snapshot names them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.evolve import merge_schemas, union_evolving
from topicflow.operators.latest import latest_per_key
from topicflow.records import quote
from topicflow.session import delete_folder, file_system, materialise, staging
from topicflow.sinks.parquet import parquet_writer

BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """From 0 to ``buckets`` - 1; nulls are keys like any other."""
    return F.pmod(F.xxhash64(*[F.col(quote(k)).cast("string") for k in keys]), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    batch: int
    buckets: int
    schema: T.StructType
    #: Per bucket the batch that holds it.
    places: dict[int, int]

    def text(self) -> str:
        places = {str(k): v for k, v in self.places.items()}
        return json.dumps(
            {"batch": self.batch, "buckets": self.buckets, "schema": self.schema.jsonValue(), "places": places}
        )

    @staticmethod
    def of(text: str) -> Snapshot:
        found = json.loads(text)
        places = {int(k): v for k, v in found["places"].items()}
        return Snapshot(found["batch"], found["buckets"], T.StructType.fromJson(found["schema"]), places)


@dataclass(frozen=True)
class KeyedTable:
    """The row with the highest ``order`` per key, then the highest ``tiebreak`` columns."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    order: str
    tiebreak: tuple[str, ...] = ()

    def snapshot(self, batch: int) -> Snapshot:
        text = self.spark.read.option("wholetext", "true").text(f"{self.path}/snapshots/{batch}.json")
        return Snapshot.of(text.first()[0])

    def rows(self, batch: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table as of a batch, or some buckets of it."""
        snapshot = self.snapshot(batch)
        wanted = snapshot.places if buckets is None else set(buckets) & snapshot.places.keys()
        paths = [self._folder(snapshot.places[b], b) for b in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], snapshot.schema)
        return self.spark.read.schema(snapshot.schema).parquet(*paths)

    def merge(self, new: DataFrame, batch: int, before: int | None, buckets: int = 64) -> Snapshot:
        """Write the table as of ``batch``: as of ``before`` with the new rows merged in.

        A batch that is run again starts from the same ``before`` and replaces only itself.
        The new rows are brought to one per key first, combined on the map side, so a key
        with very many of them is no larger than any other when its bucket is rewritten.
        """
        old = None if before is None else self.snapshot(before)
        if old is not None and old.buckets != buckets:
            raise ValueError(f"{self.path} has {old.buckets} buckets, not {buckets}")
        missing = [c for c in (*self.keys, self.order) if c not in new.columns]
        if missing:
            raise ValueError(f"not in the records: {', '.join(missing)}")
        with staging(self.spark):
            latest = latest_per_key(new, self.keys, self.order, self.tiebreak)
            fresh = materialise(latest.withColumn(BUCKET, bucket_of(self.keys, buckets)))
            touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
            known = sorted(set(touched) & old.places.keys()) if old is not None else []
            # the bucket alone decides where a row goes, which keeps its keys together too
            if known:
                base = self.rows(before, known).withColumn(BUCKET, bucket_of(self.keys, buckets))
                both = union_evolving(base, fresh).repartition(BUCKET)
                merged = latest_per_key(both, (BUCKET, *self.keys), self.order, self.tiebreak)
            else:
                merged = fresh.repartition(BUCKET)
            writer = parquet_writer(merged, "overwrite").partitionBy(BUCKET)
            writer.parquet(f"{self.path}/data/batch={batch}")
        schema = T.StructType([f for f in merged.schema if f.name != BUCKET])
        if old is not None:
            schema = merge_schemas(old.schema, schema)
        places = (old.places if old is not None else {}) | dict.fromkeys(touched, batch)
        made = Snapshot(batch, buckets, schema, places)
        self._write(made)
        return made

    def forget(self, kept: Iterable[int]) -> None:
        """Delete what only snapshots before the kept ones name."""
        kept = set(kept)
        oldest = min(kept)
        stay = {(b, n) for k in kept for b, n in self.snapshot(k).places.items()}
        fs, where = file_system(self.spark, f"{self.path}/snapshots")
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            number = int(name.removesuffix(".json")) if name.endswith(".json") else oldest
            if number < oldest:
                for bucket, batch in self.snapshot(number).places.items():
                    if (bucket, batch) not in stay:
                        delete_folder(self.spark, self._folder(batch, bucket))
                fs.delete(status.getPath(), False)

    def _folder(self, batch: int, bucket: int) -> str:
        return f"{self.path}/data/batch={batch}/{BUCKET}={bucket}"

    def _write(self, snapshot: Snapshot) -> None:
        fs, where = file_system(self.spark, f"{self.path}/snapshots/{snapshot.batch}.json")
        out = fs.create(where, True)
        out.write(bytearray(snapshot.text().encode()))
        out.close()
