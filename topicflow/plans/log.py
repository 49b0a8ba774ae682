"""The commit log of a store: what a batch published, in a bounded number of files.

    commits/00000000000000000007.json     one small file per batch, the commit itself
    manifest/batch=N                      segment parts that batch N added
    manifest/base=N                       all parts up to batch N, one row per segment
    state/batch=N                         last segment per topic-partition after batch N

A commit names the base and the deltas that make up its manifest, so a reader lists the
last few commits and opens those folders, however many batches there were.  After
COMPACT_AFTER deltas the parts are merged into a new base.  The last KEPT commits stay; what
only older ones name is deleted.  A commit file is renamed into place, so it is there as a
whole or not at all.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.records import TOPIC_PARTITION
from topicflow.session import delete_folder, file_system

KEYS = list(TOPIC_PARTITION)
COMPACT_AFTER = 16
KEPT = 3
MANIFEST = (
    "topic string, partition int, segment bigint, first_offset bigint, last_offset bigint, "
    "bytes bigint, rows bigint, last_ts bigint, schema int, sealed boolean"
)
STATE = (
    "topic string, partition int, segment bigint, rows bigint, bytes bigint, last_ts bigint, "
    "last_offset bigint, last_schema string"
)


@dataclass(frozen=True)
class Commit:
    batch: int
    base: int | None = None
    deltas: tuple[int, ...] = ()
    #: Published batches as [first, last] runs.
    published: tuple[tuple[int, int], ...] = ()
    #: Record schema of every version, transformed and as written.
    records: tuple[T.StructType, ...] = ()
    written: tuple[T.StructType, ...] = ()
    #: Topic of every version where schemas are kept per topic, else null.
    owners: tuple[str | None, ...] = ()
    #: Keyed table of every version: the batch that last wrote it.
    tables: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(
            {
                "batch": self.batch,
                "base": self.base,
                "deltas": self.deltas,
                "published": self.published,
                "records": [s.jsonValue() for s in self.records],
                "written": [s.jsonValue() for s in self.written],
                "owners": self.owners,
                "tables": self.tables,
            }
        )

    @staticmethod
    def of(text: str) -> Commit:
        found = json.loads(text)
        schemas = {k: tuple(T.StructType.fromJson(s) for s in found[k]) for k in ("records", "written")}
        return Commit(
            found["batch"],
            found["base"],
            tuple(found["deltas"]),
            tuple((a, b) for a, b in found["published"]),
            owners=tuple(found["owners"]),
            tables={int(k): v for k, v in found["tables"].items()},
            **schemas,
        )


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per segment."""
    return parts.groupBy(*KEYS, "segment").agg(
        F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"),
        F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
        F.max("last_ts").alias("last_ts"),
        F.max("schema").alias("schema"),
        F.bool_or("sealed").alias("sealed"),
    )


def with_batch(published: tuple[tuple[int, int], ...], batch: int) -> tuple[tuple[int, int], ...]:
    if published and published[-1][1] >= batch - 1:
        first, last = published[-1]
        return (*published[:-1], (first, max(last, batch)))
    return (*published, (batch, batch))


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    path: str

    def numbers(self) -> list[int]:
        fs, where = file_system(self.spark, f"{self.path}/commits")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[0] != "." and n.endswith(".json"))

    def read(self, batch: int) -> Commit:
        return Commit.of(self.spark.read.option("wholetext", "true").text(self._file(batch)).first()[0])

    def last(self) -> Commit | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def before(self, batch: int) -> Commit | None:
        """The commit that batch ``batch`` goes on from; only the last batch can be repeated."""
        numbers = self.numbers()
        if numbers and batch < numbers[-1]:
            raise ValueError(f"batch {batch} comes before batch {numbers[-1]}, which is published")
        earlier = [n for n in numbers if n < batch]
        return self.read(earlier[-1]) if earlier else None

    def parts(self, commit: Commit) -> DataFrame:
        paths = [] if commit.base is None else [self._base(commit.base)]
        return self.spark.read.schema(MANIFEST).parquet(*paths, *map(self._delta, commit.deltas))

    def state(self, commit: Commit) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(f"{self.path}/state/batch={commit.batch}")

    def write_parts(self, parts: DataFrame, batch: int) -> DataFrame:
        parts.coalesce(1).write.mode("overwrite").parquet(self._delta(batch))
        return self.spark.read.schema(MANIFEST).parquet(self._delta(batch))

    def write_state(self, state: DataFrame, batch: int) -> None:
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/batch={batch}")

    def commit(
        self, before: Commit | None, batch: int, records=(), written=(), owners=(), tables: dict[int, int] | None = None
    ) -> Commit:
        """Publish the batch whose parts and state are written."""
        before = before or Commit(-1)
        deltas = (*[d for d in before.deltas if d != batch], batch)
        new = Commit(
            batch, before.base, deltas, with_batch(before.published, batch),
            tuple(records), tuple(written), tuple(owners), dict(tables or {}),
        )
        if len(deltas) > COMPACT_AFTER:
            merged_parts(self.parts(new)).write.mode("overwrite").parquet(self._base(batch))
            new = replace(new, base=batch, deltas=())
        self._write(new)
        self._forget(new)
        return new

    def kept(self) -> list[Commit]:
        return [self.read(n) for n in self.numbers()[-KEPT:]]

    def _write(self, commit: Commit) -> None:
        fs, target = file_system(self.spark, self._file(commit.batch))
        made = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/.{uuid.uuid4().hex}")
        out = fs.create(made, True)
        out.write(bytearray(commit.text().encode()))
        out.close()
        if fs.exists(target):  # the same batch again
            fs.delete(target, False)
        if not fs.rename(made, target):
            raise OSError(f"commit {commit.batch} could not be put in place")

    def _forget(self, commit: Commit) -> None:
        numbers = self.numbers()
        for number in numbers[:-KEPT]:
            delete_folder(self.spark, self._file(number))
        kept = self.kept()
        used = {f"base={c.base}" for c in kept} | {f"batch={d}" for c in kept for d in c.deltas}
        self._clear("manifest", used, commit.batch)
        self._clear("state", {f"batch={c.batch}" for c in kept}, commit.batch)

    def _clear(self, part: str, used: set[str], batch: int) -> None:
        fs, where = file_system(self.spark, f"{self.path}/{part}")
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            if name not in used and int(name.split("=")[1]) <= batch:
                fs.delete(status.getPath(), True)

    def _file(self, batch: int) -> str:
        return f"{self.path}/commits/{batch:020d}.json"

    def _base(self, batch: int) -> str:
        return f"{self.path}/manifest/base={batch}"

    def _delta(self, batch: int) -> str:
        return f"{self.path}/manifest/batch={batch}"
