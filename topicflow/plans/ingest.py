"""Topic rows to published segments, in batches that can be repeated safely.

Layout below one root folder, every part keyed by the batch that wrote it:

    data/__batch=N/__schema=V                          records and helpers, in order of segments
    dead_letters/batch=N                               original rows and reasons
    tables/NAME/schema=V                               keyed table, see ``sinks/keyed.py``
    commits, manifest, state                           see ``plans/log.py``

A payload whose fields change type starts another version of the record schema;
each version is a table of its own, and a segment never holds two.  Segments may be as
short as a row, so files hold many: which one a row is in, and its topic and partition,
stand in columns beside the record.

A batch is published by its commit, which is written last.  A batch that failed on the
way is written again under the same number and replaces itself.  What a batch stages is
deleted at its end.

The source is read once.  The payload is shuffled once, by topic, partition and block of
offsets, where copies of an offset are dropped and rows get their segments on the way into
the files; what the cuts need is a narrow table of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.decode import drop_tombstones
from topicflow.operators.epochs import schema_epochs, split_epochs
from topicflow.operators.evolve import SchemaConflict, merge_schemas
from topicflow.operators.latest import latest_per_key
from topicflow.operators.ordered import BLOCK, BLOCK_BITS, block_of
from topicflow.operators.replay import drop_replayed
from topicflow.operators.segment import close_manifest, committed_offsets, payload_size, segment
from topicflow.plans.log import MANIFEST, Commit, CommitLog, merged_parts
from topicflow.plans.options import Options
from topicflow.plans.transform import RAW, VALUE, explode_rows, inference, split_rows, transform_rows
from topicflow.records import ENVELOPE, INVALID, TOPIC_PARTITION, quote
from topicflow.session import delete_folder, materialise, staging
from topicflow.sinks.keyed import KeyedTable
from topicflow.sinks.parquet import parquet_writer, row_group_bytes_for, write_dead_letters

KEYS = list(TOPIC_PARTITION)
# Helper columns beside the record; the schema's version is a folder.
PLACE = T.StructType().add("__topic", T.StringType()).add("__partition", T.IntegerType()).add("__segment", T.LongType())
COUNTED = T.StructType([T.StructField(n, T.LongType()) for n in ("__offset", "__bytes", "__ts")])
NOTHING = "__nothing"
MOST_TOPICS = 1000
ROW = "__row"


@dataclass(frozen=True)
class Store:
    """The published output under one root folder."""

    spark: SparkSession
    path: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path)

    def parts(self) -> DataFrame | None:
        """Segment parts of all published batches."""
        last = self.log.last()
        return None if last is None else self.log.parts(last)

    def manifest(self, options: Options, now: Column | None = None) -> DataFrame | None:
        """One row per segment; ``closed`` follows from what came after it and,
        given ``now``, from how long it has been idle."""
        parts = self.parts()
        if parts is None:
            return None
        whole = merged_parts(parts).withColumnRenamed("sealed", "__sealed")
        found = close_manifest(whole, options.max_records, options.max_bytes, options.idle, now)
        return found.withColumn("closed", F.col("closed") | F.col("__sealed")).drop("__sealed")

    def committed(self, options: Options, now: Column | None = None) -> DataFrame | None:
        manifest = self.manifest(options, now)
        return None if manifest is None else committed_offsets(manifest)

    def schemas(self) -> list[T.StructType]:
        """Record schema of every version, in the order in which they began."""
        last = self.log.last()
        return [] if last is None else list(last.written)

    def versions_of(self, topic: str) -> list[int]:
        """Versions of a topic whose schemas are kept apart, in the order in which they began."""
        last = self.log.last()
        return [] if last is None else [i for i, owner in enumerate(last.owners) if owner == topic]

    def _version(self, last: Commit | None, version: int | None) -> int:
        if last is None:
            raise ValueError(f"nothing is published under {self.path}")
        if version is None and len(last.written) > 1:
            raise ValueError(f"the records have {len(last.written)} schemas: name a version")
        return range(len(last.written))[version or 0]

    def rows(self, lineage: bool = False, version: int | None = None) -> DataFrame:
        """All published records, unfinished batches left out; ``lineage`` adds
        topic, partition, segment and offset as ``__topic`` and so on.

        ``version`` picks one of ``schemas()`` and is needed where there are
        several, since one frame cannot hold them all."""
        last = self.log.last()
        version = self._version(last, version)
        record = last.written[version]
        schema = T.StructType([*record, *COUNTED, *PLACE]).add("__batch", T.LongType()).add("__schema", T.IntegerType())
        df = self.spark.read.schema(schema).parquet(f"{self.path}/data")
        batch = F.col("__batch")
        done = reduce(Column.__or__, [batch.between(a, b) for a, b in last.published])
        df = df.filter(done & (F.col("__schema") == version))
        names = ("__topic", "__partition", "__segment", "__offset") if lineage else ()
        return df.select(*[quote(n) for n in (*[f.name for f in record], *names)])

    def latest(self, options: Options, version: int | None = None) -> DataFrame:
        """The keyed table: of the published records the one with the highest order per key."""
        last = self.log.last()
        version = self._version(last, version)
        if version not in last.tables:
            raise ValueError("no keyed table is published: the options need keys")
        table = keyed_table(self.spark, self.path, options, version)
        return table.rows(last.tables[version]).select(*[quote(f.name) for f in last.written[version]])


TIEBREAK = ("__batch", "__topic", "__partition", "__offset")


def keyed_table(spark: SparkSession, path: str, options: Options, version: int) -> KeyedTable:
    """Of rows with equal order the one of the later batch wins, then of the higher offset."""
    folder = f"{path}/tables/{options.table}/schema={version}"
    return KeyedTable(spark, folder, options.keys, options.order_column, TIEBREAK)


def _versioned(
    df: DataFrame, options: Options, versions: list[T.StructType]
) -> tuple[list[tuple[DataFrame, int]], list[T.StructType]]:
    """Transformed rows with the schema version they belong to, and all versions.

    Normally that is one frame on the newest version.  Only when types conflict
    are schemaless rows cut into epochs.  Epochs that do not conflict go together
    to the newest version they fit, or start one; each is decoded once.
    """
    try:
        rows, schema = transform_rows(df, options, versions[-1] if versions else None)
        versions = [*versions[:-1], schema]
        return [(rows, len(versions) - 1)], versions
    except SchemaConflict:
        if options.format != "json" or options.schema is not None:
            raise
    frames, versions = [], list(versions)
    # epochs want each offset once
    staged = materialise(schema_epochs(drop_tombstones(drop_replayed(df))))
    for inferred, part in split_epochs(staged, **inference(options)):
        for version in reversed(range(len(versions))):
            try:
                rows, schema = transform_rows(part, options, versions[version], inferred)
                versions[version] = schema
                break
            except SchemaConflict:
                continue
        else:
            rows, schema = transform_rows(part, options, None, inferred)
            version = len(versions)
            versions.append(schema)
        frames.append((rows, version))
    return frames, versions


def _versioned_by_topic(
    df: DataFrame, options: Options, versions: list[T.StructType], owners: list[str | None]
) -> tuple[list[tuple[DataFrame, int]], list[T.StructType], list[str | None]]:
    """As ``_versioned``, with versions of its own for every topic."""
    topics = [r[0] for r in df.select("topic").distinct().limit(MOST_TOPICS + 1).collect()]
    if len(topics) > MOST_TOPICS:
        raise ValueError(f"more than {MOST_TOPICS} topics in a batch")
    versions, owners, out = list(versions), list(owners), []
    for topic in sorted(topics):
        own = [i for i, owner in enumerate(owners) if owner == topic]
        frames, found = _versioned(df.filter(F.col("topic") == topic), options, [versions[i] for i in own])
        for i, schema in enumerate(found):
            if i == len(own):
                own.append(len(versions))
                versions.append(schema)
                owners.append(topic)
            versions[own[i]] = schema
        out += [(rows, own[i]) for rows, i in frames]
    return out, versions, owners


def publish(
    df: DataFrame,
    batch: int,
    path: str,
    options: Options,
    keep_open: bool = True,
    flush: bool = False,
) -> None:
    """Transform, segment and publish one batch of topic rows.

    ``keep_open`` lets the last segment of a topic-partition go on in the next
    batch.  Otherwise rows of segments still open are not published and have to
    be read again, unless ``flush`` closes them.  Only the last batch can be
    repeated.
    """
    spark = df.sparkSession
    with staging(spark):
        _publish(spark, df, batch, path, options, keep_open, flush)


def _publish(
    spark: SparkSession, df: DataFrame, batch: int, path: str, options: Options, keep_open: bool, flush: bool
) -> None:
    log = CommitLog(spark, path)
    last = log.before(batch)
    opened = None if last is None else log.state(last)
    source = materialise(_beyond(df.select(*ENVELOPE, VALUE), opened))
    known = Commit(-1) if last is None else last
    if options.schema_per_topic:
        frames, versions, owners = _versioned_by_topic(source, options, list(known.records), list(known.owners))
    else:
        frames, versions = _versioned(source, options, list(known.records))
        owners = [None] * len(versions)
    if not frames:  # a batch of no rows at all
        frames, versions = [*_versioned(source, options, [])[0]], versions or [T.StructType()]
        owners = owners or [None]
    # payloads are decoded here once; what follows reads the columns it needs
    staged = [(materialise(_counted(rows)), version) for rows, version in frames]
    split = [(*split_rows(rows, options), version) for rows, version in staged]
    dead = reduce(DataFrame.unionAll, [d.drop("__bytes", ROW) for _, d, _ in split])
    write_dead_letters(dead.dropDuplicates([*KEYS, "offset"]), f"{path}/dead_letters/batch={batch}", "overwrite")

    valid = [(v, version) for v, _, version in split]
    # without rules every topic-partition has a single segment, and the parts tell it
    ruled = any((options.max_records, options.max_bytes, options.idle)) or len(versions) > 1
    cut = _cut(valid, options, opened, len(versions) > 1)
    cut = materialise(cut) if ruled else cut
    parts = _parts(cut)
    if not keep_open and not flush:
        closed = close_manifest(parts, options.max_records, options.max_bytes, options.idle)
        parts = closed.filter("closed").drop("closed", "file_name")
    parts = log.write_parts(_sealed(parts, not keep_open), batch)

    data = f"{path}/data/__batch={batch}"
    written = [] if last is None else list(last.written)
    written += [T.StructType()] * (len(versions) - len(written))
    size = row_group_bytes_for(options.row_group_bytes, options.max_bytes)
    tables = {} if last is None else dict(last.tables)
    delete_folder(spark, data)
    for rows, version in valid:
        out = explode_rows(_placed(rows, cut, parts) if ruled else _placed_whole(rows, parts), options)
        record = T.StructType([f for f in out.schema[VALUE].dataType if f.name != NOTHING])
        written[version] = merge_schemas(written[version], record)
        _check_order(options, written[version])
        out = out.select(
            *[F.col(f"{VALUE}.{quote(f.name)}") for f in record],
            F.col("offset").alias("__offset"), "__bytes", F.unix_millis("timestamp").alias("__ts"),
            *[F.col(n[2:]).alias(n) for n in PLACE.names],
        )
        parquet_writer(out, "append", size).parquet(f"{data}/__schema={version}")
    if options.keys:
        for version in sorted({v for _, v in valid}):
            if written[version]:
                _merge(spark, data, batch, path, options, version, written[version], tables)
    log.write_state(_state(parts, opened, keep_open), batch)
    commit(log, last, batch, versions, written, owners, tables)
    for version, at in tables.items():
        known = {c.tables[version] for c in log.kept() if version in c.tables}
        keyed_table(spark, path, options, version).forget({at, *known})


def commit(log: CommitLog, last: Commit | None, batch: int, *what) -> None:
    log.commit(last, batch, *what)


def _beyond(df: DataFrame, opened: DataFrame | None) -> DataFrame:
    """Rows past the last offset of their topic-partition; the state is small and written."""
    if opened is None:
        return df
    known = opened.select(*KEYS, F.col("last_offset").alias("__last"))
    new = F.col("__last").isNull() | (F.col("offset") > F.col("__last"))
    return df.join(known, KEYS, "left").filter(new).select(*df.columns)


def _check_order(options: Options, record: T.StructType) -> None:
    if options.keys and record and options.order_column not in record.names:
        raise ValueError(f"the records have no order column {options.order_column!r}")


def _merge(
    spark: SparkSession, data: str, batch: int, path: str, options: Options, version: int,
    record: T.StructType, tables: dict[int, int],
) -> None:
    """Merge what the batch wrote into the keyed table of a version."""
    schema = T.StructType([*record, *COUNTED, *PLACE])
    new = spark.read.schema(schema).parquet(f"{data}/__schema={version}")
    new = new.withColumn("__batch", F.lit(batch).cast("bigint"))
    new = new.select(*[quote(f.name) for f in record], *TIEBREAK)
    table = keyed_table(spark, path, options, version)
    table.merge(new, batch, tables.get(version), options.buckets)
    tables[version] = batch


def _parts(cut: DataFrame) -> DataFrame:
    """One row per segment of a batch."""
    return cut.groupBy(*KEYS, "segment").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum("__bytes").alias("bytes"),
        F.count("*").alias("rows"),
        F.max("__ts").alias("last_ts"),
        F.max("__number").alias("schema"),
    )


def _sealed(parts: DataFrame, sealed: bool) -> DataFrame:
    names = T._parse_datatype_string(MANIFEST).names
    return parts.withColumn("sealed", F.lit(sealed)).select(*names)


def track(df: DataFrame, batch: int, path: str, options: Options, size: Column) -> None:
    """Segment one batch of topic rows without publishing them: manifest and state only.

    Only offset, size and time of a row are moved, and a hot topic-partition is cut block
    by block as in ``publish``, so nothing depends on how many rows a batch has of one.
    """
    spark = df.sparkSession
    with staging(spark):
        log = CommitLog(spark, path)
        last = log.before(batch)
        opened = None if last is None else log.state(last)
        narrow = df.select(*KEYS, F.col("offset").cast("bigint").alias("offset"), "timestamp", size.alias("__bytes"))
        narrow = _beyond(narrow, opened).withColumn(ROW, F.monotonically_increasing_id())
        cut = materialise(_cut([(materialise(narrow), 0)], options, opened, False))
        parts = log.write_parts(_sealed(_parts(cut), False), batch)
        log.write_state(_state(parts, opened, True), batch)
        commit(log, last, batch)


def _counted(rows: DataFrame) -> DataFrame:
    """Add the payload size and a row number; keep the original payload of invalid rows only."""
    if not rows.schema[VALUE].dataType.fields:
        # no readable record at all, and Parquet has no empty structs
        rows = rows.withColumn(VALUE, F.struct(F.lit(None).cast("string").alias(NOTHING)))
    raw = F.when(F.size(INVALID) > 0, F.col(RAW))
    return rows.withColumns(
        {RAW: raw, "__bytes": payload_size(rows, VALUE), ROW: F.monotonically_increasing_id()}
    )


def _cut(
    frames: list[tuple[DataFrame, int]], options: Options, opened: DataFrame | None, by_schema: bool
) -> DataFrame:
    """Every offset once, without its payload, and its ``segment``; of copies the first row stays.

    Segments are numbered over the frames of all versions together.
    """
    rules = (options.max_records, options.max_bytes, options.idle)
    narrow = reduce(
        DataFrame.unionAll,
        [
            rows.select(
                *KEYS, "offset", ROW,
                F.struct("timestamp", "__bytes", F.lit(v).alias("__number")).alias("row"),
            )
            for rows, v in frames
        ],
    )
    narrow = narrow.groupBy(*KEYS, "offset").agg(F.min_by("row", ROW).alias("row"))
    narrow = narrow.select(*KEYS, "offset", "row.*")
    ts = F.unix_millis("timestamp").alias("__ts")
    if not any(rules) and not by_schema:
        if opened is None:
            return narrow.select("*", ts, F.lit(0).cast("bigint").alias("segment"))
        following = opened.select(*KEYS, F.col("segment").alias("__next"))
        narrow = narrow.join(following, KEYS, "left")
        return narrow.select("*", ts, F.coalesce("__next", F.lit(0)).alias("segment")).drop("__next")
    narrow = materialise(narrow.withColumn("__version", F.col("__number").cast("string")))
    watched = "__version" if by_schema else None
    return segment(narrow, *rules, watched, F.col("__bytes"), opened).select("*", ts)


def _placed(rows: DataFrame, cut: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with their published segment; the one place where payloads are shuffled.

    Each block of a topic-partition gets the marks at which its segments begin.  Within the
    block, in the order of offsets, a row takes the last mark before it, and of rows with
    one offset the first stays.
    """
    block = block_of("offset", BLOCK_BITS).alias(BLOCK)
    begins = cut.groupBy(*KEYS, block, "segment").agg(F.min("offset").alias("offset"))
    published = parts.select(*KEYS, "segment", F.lit(True).alias("__out"))
    begins = begins.join(published, [*KEYS, "segment"], "left")
    names = rows.columns
    filler = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema}
    marks = begins.select(
        *[F.col(n) if n in (*KEYS, "offset") else filler[n] for n in names],
        BLOCK, "segment", F.coalesce("__out", F.lit(False)).alias("__out"), F.lit(0).alias("__rank"),
    )
    nothing = (F.lit(None).cast("bigint").alias("segment"), F.lit(None).cast("boolean").alias("__out"))
    both = rows.select(*names, block, *nothing, F.lit(1).alias("__rank")).unionAll(marks)
    keys = [*KEYS, BLOCK]
    upto = Window.partitionBy(*keys).orderBy("offset", "__rank", ROW)
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copies = Window.partitionBy(*keys, "offset", "__rank").orderBy(ROW)
    filled = both.withColumns(
        {
            "segment": F.last("segment", ignorenulls=True).over(upto),
            "__out": F.last("__out", ignorenulls=True).over(upto),
        }
    ).withColumn("__copy", F.row_number().over(copies))
    kept = filled.filter((F.col("__rank") == 1) & (F.col("__copy") == 1) & F.col("__out"))
    return kept.select(*names, "segment").drop(ROW)


def _placed_whole(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """As ``_placed`` where a topic-partition has one segment in the batch."""
    copies = Window.partitionBy(*KEYS, BLOCK, "offset").orderBy(ROW)
    placed = rows.join(F.broadcast(parts.select(*KEYS, "segment")), KEYS)
    placed = placed.withColumn(BLOCK, block_of("offset", BLOCK_BITS))
    kept = placed.withColumn("__copy", F.row_number().over(copies)).filter("__copy = 1")
    return kept.select(*[c for c in rows.columns if c != ROW], "segment")


def _state(parts: DataFrame, opened: DataFrame | None, keep_open: bool) -> DataFrame:
    """Last segment per topic-partition: where the next batch goes on."""
    version = F.col("schema").cast("string").alias("last_schema")
    now = parts.select(*KEYS, "segment", "rows", "bytes", "last_ts", "last_offset", version)
    if opened is not None:
        # the open segment may have got more rows: add up its parts
        before = opened.select(*now.columns)
        now = (
            now.unionAll(before)
            .groupBy(*KEYS, "segment")
            .agg(
                F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                F.max("last_ts").alias("last_ts"), F.max("last_offset").alias("last_offset"),
                F.max("last_schema").alias("last_schema"),
            )
        )
    newest = latest_per_key(now, KEYS, "segment")
    if not keep_open:
        # published segments are sealed, so the next row opens another one; a
        # state without rows already points there
        newest = newest.withColumns(
            {
                "segment": F.col("segment") + F.when(F.col("rows") > 0, 1).otherwise(0),
                "rows": F.lit(0).cast("bigint"),
                "bytes": F.lit(0).cast("bigint"),
                "last_ts": F.lit(None).cast("bigint"),
                "last_schema": F.lit(None).cast("string"),
            }
        )
    return newest


def ingest_batch(
    spark: SparkSession, df: DataFrame, path: str, options: Options, flush: bool = False
) -> Store:
    """Publish the closed segments of a static frame; with ``flush`` the open ones too.

    Running it again on the same or a longer topic publishes only what is new.
    """
    store = Store(spark, path)
    last = store.log.last()
    ruled = any((options.max_records, options.max_bytes, options.idle))
    publish(df, 0 if last is None else last.batch + 1, path, options, keep_open=False, flush=flush or not ruled)
    return store
