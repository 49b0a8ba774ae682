"""Every operator as a query over the test tables, with its SQL where there is one.

The ``events`` table plays the topic: topic = event_type, partition =
user_id % 4, offset = event_id (unique, rising), payload = props or JSON built
from the row.  Nothing is grouped to build the input, so no key can pile up.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators import declared, decode, evolve, infer, latest, segment as seg
from topicflow.operators.convert import decimals_to_double, lowercase_fields
from topicflow.operators.epochs import epoch_fields, schema_epochs
from topicflow.operators.explode import explode_container
from topicflow.operators.flatten import chunk_json, flatten
from topicflow.operators.mask import Mask, mask
from topicflow.operators.metadata import embed_metadata
from topicflow.operators.replay import drop_replayed
from topicflow.operators.validate import split_invalid, validate_keys
from topicflow.plans.ingest import Store, ingest_batch, publish
from topicflow.plans.options import Options
from topicflow.plans.transform import transform
from topicflow.session import checkpoint_folder
from topicflow.sinks.parquet import read_table, upsert_table, write_dead_letters, write_segments
from topicflow.sources.topic import as_topic, read_topic
from topicflow.streaming.ingest import ingest_stream
from topicflow.streaming.segments import idle_sessions, track_segments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# ------------------------------------------------------------------ inputs

TOPIC_SQL = """
WITH t AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id AS "offset", epoch_us(ts) // 1000 AS ms, user_id, value, props,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k, strlen(props) AS size
  FROM events)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_events_topic(events: DataFrame, value=None) -> DataFrame:
    return as_topic(
        events,
        topic=F.col("event_type"),
        partition=F.col("user_id") % 4,
        offset=F.col("event_id"),
        timestamp=F.col("ts"),
        value=F.col("props") if value is None else value,
    )


def events_topic(spark: SparkSession, sf_dir: str, value=None) -> DataFrame:
    return as_events_topic(table(spark, sf_dir, "events"), value)


def text(*parts):
    """JSON or XML text from literals and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def event_json():
    """{"user":{"id":8,"kind":"click"},"amount":6.55,"tags":["click",8],"props":{"k":69}}"""
    user, kind = F.col("user_id"), F.col("event_type")
    return text(
        '{"user":{"id":', user, ',"kind":"', kind, '"},"amount":', F.col("value"),
        ',"tags":["', kind, '",', user, '],"props":', F.col("props"), "}",
    )


def mixed_json():
    """Payloads of which some are no records at all, or have no usable key."""
    user, props = F.col("user_id"), F.col("props")
    number = F.col("event_id") % 8
    return (
        F.when(number == 1, text("[", user, "]"))
        .when(number == 2, text('"', F.col("event_type"), '"'))
        .when(number == 3, F.lit("{ }"))
        .when(number == 4, text('{"":', user, "}"))
        .when(number == 5, text('{"user":', user))
        .when(number == 6, text('{"user":null,"props":', props, "}"))
        .otherwise(text('{"user":', user, ',"props":', props, "}"))
    )


MIXED_REASON_SQL = """
  CASE "offset" % 8 WHEN 1 THEN 'payload is not an object' WHEN 2 THEN 'payload is not an object'
       WHEN 3 THEN 'payload is an empty object' WHEN 4 THEN 'empty key'
       WHEN 5 THEN 'payload does not match the schema' WHEN 6 THEN 'null key: user' END
"""


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ sources and decoding


@query(TOPIC_SQL + """SELECT topic, "partition", "offset", ms, props AS value FROM t""")
def read_events_topic(spark, sf_dir):
    rows = events_topic(spark, sf_dir)
    return rows.select("topic", "partition", "offset", F.unix_millis("timestamp").alias("ms"), "value")


@query(TOPIC_SQL + """
SELECT topic, "partition", "offset", props AS value FROM t WHERE user_id % 10 <> 0""")
def tombstones(spark, sf_dir):
    value = F.when(F.col("user_id") % 10 != 0, F.col("props"))
    rows = decode.drop_tombstones(events_topic(spark, sf_dir, value))
    return rows.select("topic", "partition", "offset", "value")


@query(TOPIC_SQL + """
SELECT "offset", user_id, topic AS user_kind, value AS amount,
       '["' || topic || '",' || user_id || ']' AS tags, k AS props_k FROM t""")
def decode_json(spark, sf_dir):
    rows = flatten(decode.decode_json(events_topic(spark, sf_dir, event_json())), "value")
    return rows.select("offset", "value.*")


@query(TOPIC_SQL + """SELECT "offset", user_id AS id, topic AS kind, k, true AS ok FROM t""")
def decode_declared(spark, sf_dir):
    value = text(
        '{"id":', F.col("user_id"), ',"kind":"', F.col("event_type"), '","props":', F.col("props"), "}"
    )
    schema = T.StructType.fromDDL("id bigint, kind string, props struct<k: bigint>")
    rows = decode.decode_json(events_topic(spark, sf_dir, value), schema)
    return rows.select("offset", "value.id", "value.kind", "value.props.k", (F.size("_invalid") == 0).alias("ok"))


ENVELOPE_SCHEMA = (
    '{"type":"struct","fields":[{"field":"id","type":"int64"},{"field":"kind","type":"string"},'
    '{"field":"tags","type":"array","items":{"type":"string"}}]}'
)


@query(TOPIC_SQL + """
SELECT "offset", user_id AS id, topic AS kind, '["' || topic || '"]' AS tags FROM t""")
def decode_envelope(spark, sf_dir):
    value = text(
        '{"schema":' + ENVELOPE_SCHEMA + ',"payload":{"id":', F.col("user_id"), ',"kind":"',
        F.col("event_type"), '","tags":["', F.col("event_type"), '"]}}',
    )
    rows = flatten(declared.decode_declared(events_topic(spark, sf_dir, value)), "value")
    return rows.select("offset", "value.*")


LOGICAL = "org.apache.kafka.connect.data."
PLAIN_FIELDS = '{"field":"id","type":"int64"},{"field":"kind","type":"string"}'
LOGICAL_FIELDS = ",".join(
    [
        f'{{"field":"amount","type":"bytes","name":"{LOGICAL}Decimal","parameters":{{"scale":"2"}}}}',
        f'{{"field":"day","type":"int32","name":"{LOGICAL}Date"}}',
        f'{{"field":"at","type":"int32","name":"{LOGICAL}Time"}}',
        f'{{"field":"ts","type":"int64","name":"{LOGICAL}Timestamp"}}',
        '{"field":"origin","type":"string","default":"web"}',
    ]
)


def own_schema_json():
    """Odd events declare and bring logical types; some rows do not match what they declare."""
    number, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    cents = F.round(F.col("value") * 100).cast("bigint") * F.when(number % 4 == 1, -1).otherwise(1)
    amount = F.base64(F.unhex(F.lpad(F.hex(cents), 16, "0")))
    ends = text(
        ',"amount":"', amount, '","day":', number % 40_000 - 10_000, ',"at":', number * 7919 % 86_400_000,
        ',"ts":', F.unix_millis(F.col("ts").cast("timestamp")), "}}",
    )
    plain = text('{"id":', user, ',"kind":"', kind, '"')
    plain = F.when(number % 7 == 2, text('{"id":', user, ',"kind":', user)).otherwise(plain)
    plain = F.when(number % 7 == 4, text('{"id":', user)).otherwise(plain)
    plain = F.when(number % 7 == 6, text('{"id":"', user, '","kind":"', kind, '"')).otherwise(plain)
    small = F.concat(F.lit('{"schema":{"type":"struct","fields":[' + PLAIN_FIELDS + ']},"payload":'), plain, F.lit("}}"))
    large = F.concat(
        F.lit('{"schema":{"type":"struct","fields":[' + PLAIN_FIELDS + "," + LOGICAL_FIELDS + ']},"payload":'), plain, ends
    )
    value = F.when(number % 2 == 1, large).otherwise(small)
    return F.when(number % 11 == 5, F.concat(F.lit('{"payload":'), plain, F.lit("}}"))).otherwise(value)


@query(TOPIC_SQL + """
, p AS (SELECT *, CASE WHEN "offset" % 11 = 5 THEN 'payload has no schema and payload fields'
    WHEN "offset" % 7 = 2 THEN 'not a string: kind' WHEN "offset" % 7 = 4 THEN 'required: kind'
    WHEN "offset" % 7 = 6 THEN 'not an int64: id' END AS reason FROM t),
q AS (SELECT *, reason IS NULL AS ok, reason IS NULL AND "offset" % 2 = 1 AS large FROM p)
SELECT "offset", reason, CASE WHEN ok THEN user_id END AS id, CASE WHEN ok THEN topic END AS kind,
  CASE WHEN large THEN CAST(CAST(round(value * 100) * CASE "offset" % 4 WHEN 1 THEN -1 ELSE 1 END AS DECIMAL(18, 0))
    * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(38, 2))::VARCHAR END AS amount,
  CASE WHEN large THEN CAST(DATE '1970-01-01' + CAST("offset" % 40000 - 10000 AS INTEGER) AS DATE)::VARCHAR END AS day,
  CASE WHEN large THEN CAST("offset" * 7919 % 86400000 AS INTEGER) END AS at, CASE WHEN large THEN ms END AS ts,
  CASE WHEN large THEN 'web' END AS origin FROM q""")
def declared_own_schema(spark, sf_dir):
    """Every row against the schema it brings, logical types and a default included."""
    rows = declared.decode_declared(events_topic(spark, sf_dir, own_schema_json()))
    return rows.select(
        "offset", F.get("_invalid", F.lit(0)).alias("reason"), "value.id", "value.kind",
        F.col("value.amount").cast("string").alias("amount"), F.col("value.day").cast("string").alias("day"),
        "value.at", F.unix_millis("value.ts").alias("ts"), "value.origin",
    )


@query("""
SELECT l_orderkey AS "offset", CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS VARCHAR) AS part_key,
       l_returnflag AS part_flag, l_linestatus AS status,
       '["' || l_returnflag || '","' || l_linestatus || '"]' AS flag FROM lineitem""")
def decode_xml(spark, sf_dir):
    value = text(
        '<row line="', F.col("l_linenumber"), '"><flag>', F.col("l_returnflag"), "</flag><part><key>",
        F.col("l_partkey"), "</key><flag>", F.col("l_returnflag"), "</flag></part><status>",
        F.col("l_linestatus"), "</status><flag>", F.col("l_linestatus"), "</flag></row>",
    )
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("offset"), value.alias("value"))
    return flatten(decode.decode_xml(rows), "value").select("offset", "value.*")


@query(TOPIC_SQL + """
SELECT "offset", CASE "offset" % 8 WHEN 3 THEN 'payload is an empty object' WHEN 5 THEN 'malformed payload'
  ELSE 'payload is not an object' END AS reason FROM t
WHERE "offset" % 8 IN (1, 2, 3, 5)""")
def require_object(spark, sf_dir):
    """Only the shape is checked here, so an empty key or a null is no fault."""
    rows = decode.require_object(events_topic(spark, sf_dir, mixed_json()))
    return rows.filter(F.size("_invalid") > 0).select("offset", F.col("_invalid")[0].alias("reason"))


# ------------------------------------------------------------------ inference and evolution


@query(TOPIC_SQL + """
SELECT f.field, f.type, min(t."offset") AS first, count(*) AS rows FROM t,
  (VALUES ('user', 'struct'), ('user.id', 'bigint'), ('user.kind', 'string'), ('amount', 'double'),
          ('tags', 'list'), ('props', 'struct'), ('props.k', 'bigint')) f(field, type)
GROUP BY f.field, f.type""")
def infer_schema_rows(spark, sf_dir):
    fields = infer.field_types(events_topic(spark, sf_dir, event_json()))
    return fields.select(F.array_join("path", ".").alias("field"), "type", "first", "rows")


def changing_json():
    """Field ``k`` turns from number to text and back; ``note`` is in some rows only."""
    k = F.get_json_object("props", "$.k")
    as_text = F.expr("event_id div 700") % 2 == 1
    return F.when(as_text, text('{"k":"', k, '","note":"', F.col("event_type"), '"}')).otherwise(
        text('{"k":', k, "}")
    )


CHANGING_SQL = TOPIC_SQL + """
, c AS (SELECT *, ("offset" // 700) % 2 AS kind FROM t),
l AS (SELECT *, lag(kind) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS before FROM c),
e AS (SELECT *, CAST(sum(CASE WHEN kind <> before THEN 1 ELSE 0 END)
             OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS BIGINT) AS epoch FROM l)
"""


@query(CHANGING_SQL + """SELECT topic, "partition", "offset", epoch FROM e""")
def schema_epoch_rows(spark, sf_dir):
    rows = schema_epochs(events_topic(spark, sf_dir, changing_json()))
    return rows.select("topic", "partition", "offset", "epoch")


@query(CHANGING_SQL + """
SELECT topic, "partition", epoch, 'k' AS field, CASE kind WHEN 1 THEN 'string' ELSE 'bigint' END AS type,
       count(*) AS rows FROM e GROUP BY topic, "partition", epoch, kind
UNION ALL
SELECT topic, "partition", epoch, 'note', 'string', count(*) FROM e WHERE kind = 1
GROUP BY topic, "partition", epoch""")
def schema_epoch_fields(spark, sf_dir):
    fields = epoch_fields(schema_epochs(events_topic(spark, sf_dir, changing_json())))
    return fields.select("topic", "partition", "epoch", F.array_join("path", ".").alias("field"), "type", "rows")


@query(CHANGING_SQL + """
SELECT 'k' AS field, CASE kind WHEN 1 THEN 'string' ELSE 'bigint' END AS type,
       min("offset") AS first_offset, count(*) AS rows FROM c GROUP BY kind""")
def schema_conflicts(spark, sf_dir):
    return infer.schema_conflicts(events_topic(spark, sf_dir, changing_json()))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o_orderkey, o_custkey, o_orderpriority, NULL AS o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def align_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    final = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus")
    other = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority", "o_custkey")
    return evolve.union_evolving(final, other)


@query("""
SELECT o_orderkey, o_custkey AS cust_key, NULL::VARCHAR AS cust_segment, o_orderstatus AS status,
       '[{"code":"' || o_orderpriority || '","note":null}]' AS notes,
       '{"status":{"value":"' || o_orderstatus || '","by":null}}' AS marks FROM orders""")
def align_nested(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("key")).alias("cust"),
        F.col("o_orderstatus").alias("status"),
        F.array(F.struct(F.col("o_orderpriority").alias("code"))).alias("notes"),
        F.create_map(F.lit("status"), F.struct(F.col("o_orderstatus").alias("value"))).alias("marks"),
    )
    wider = T.StructType.fromDDL(
        "o_orderkey bigint, cust struct<key: bigint, segment: string>, status string, "
        "notes array<struct<code: string, note: string>>, "
        "marks map<string, struct<value: string, by: string>>"
    )
    return flatten(evolve.align_to(rows, wider))


# ------------------------------------------------------------------ conversion, flattening


def nested_orders(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.select(
        F.col("o_orderkey").alias("key"),
        F.struct(
            F.col("c_custkey").alias("key"),
            F.col("c_name").alias("full name"),
            F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("home#"),
        ).alias("customer"),
        F.col("o_totalprice").alias("price"),
    )


@query("""
SELECT o_orderkey AS key, c_custkey AS customer_key, c_name AS customer_full_name,
       c_nationkey AS customer_home__nation, c_mktsegment AS customer_home__segment, o_totalprice AS price
FROM orders JOIN customer ON o_custkey = c_custkey""")
def flatten_orders(spark, sf_dir):
    return flatten(nested_orders(spark, sf_dir))


def rows_with_collections(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            F.array("l_returnflag", F.lit(None).cast("string"), "l_linestatus").alias("flags"),
            F.create_map(F.lit("part"), "l_partkey", F.lit("supp"), "l_suppkey").alias("ids"),
            F.array(F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("f"))).alias("items"),
            F.create_map("l_linenumber", "l_partkey").alias("by_line"),
        ).alias("more"),
    )


@query("""
SELECT l_orderkey, l_linenumber, '["' || l_returnflag || '",null,"' || l_linestatus || '"]' AS more_flags,
       '{"part":' || l_partkey || ',"supp":' || l_suppkey || '}' AS more_ids,
       '[{"n":' || l_linenumber || ',"f":"' || l_returnflag || '"}]' AS more_items,
       '[[' || l_linenumber || ',' || l_partkey || ']]' AS more_by_line FROM lineitem""")
def flatten_json_collections(spark, sf_dir):
    return flatten(rows_with_collections(spark, sf_dir))


@query("SELECT l_orderkey, l_linenumber FROM lineitem")
def flatten_discard(spark, sf_dir):
    return flatten(rows_with_collections(spark, sf_dir), discard_collections=True)


@query("""
SELECT l_orderkey, CAST(CAST(l_quantity AS DECIMAL(12, 2)) AS DOUBLE) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS DOUBLE) AS price_gross,
       CAST(CAST(l_tax AS DECIMAL(9, 5)) AS DOUBLE) AS first_tax FROM lineitem""")
def decimals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        F.struct(F.col("l_extendedprice").cast("decimal(14,2)").alias("gross")).alias("price"),
        F.array(F.col("l_tax").cast("decimal(9,5)")).alias("taxes"),
    )
    rows = decimals_to_double(rows)
    return rows.select("l_orderkey", "quantity", "price.gross", F.col("taxes")[0].alias("first_tax")).withColumnRenamed(
        "gross", "price_gross"
    )


@query("""
SELECT c_custkey AS custkey, c_name AS person_name, c_mktsegment AS person_segment FROM customer""")
def lowercase(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustKey"),
        F.struct(F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("SEGMENT")).alias("pErson"),
    )
    return flatten(lowercase_fields(rows))


@query("""
WITH j AS (SELECT l_orderkey, l_linenumber, '{"part":' || l_partkey || ',"supp":' || l_suppkey ||
  ',"flag":"' || l_returnflag || '","status":"' || l_linestatus || '"}' AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, substr(t, 1, 20) AS payload_chunk1,
       nullif(substr(t, 21, 20), '') AS payload_chunk2, nullif(substr(t, 41, 20), '') AS payload_chunk3,
       nullif(substr(t, 61, 20), '') AS payload_chunk4 FROM j""")
def chunk_json_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
    )
    return chunk_json(rows, 4, 20, keep=("l_orderkey", "l_linenumber"))


@query("""
SELECT doc_id, CAST(ceil(strlen(text) / 4096.0) AS BIGINT) AS chunks FROM documents""")
def chunk_documents(spark, sf_dir):
    """Whole texts in 4 KiB pieces; a job over them must find every piece used."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = chunk_json(docs, 64, 4096, "text")
    pieces = [F.col(f"text.payload_chunk{i + 1}").isNotNull().cast("bigint") for i in range(64)]
    total = pieces[0]
    for p in pieces[1:]:
        total = total + p
    return cut.select("doc_id", total.alias("chunks"))


@query(TOPIC_SQL + """
SELECT "partition" AS "kafkaPartition", "offset" AS "kafkaOffset", ms AS "kafkaTimestamp",
       "partition" || '_' || "offset" AS "kafkaPartitionOffset", "offset" AS "__order", props FROM t""")
def embed_metadata_columns(spark, sf_dir):
    rows = embed_metadata(events_topic(spark, sf_dir), order_column="__order")
    return rows.select("kafkaPartition", "kafkaOffset", "kafkaTimestamp", "kafkaPartitionOffset", "__order", F.col("value").alias("props"))


@query("""
SELECT conv_id, turn, m.role, m.text FROM (
  SELECT conv_id, turn, unnest([{'role': role, 'text': text}, {'role': 'copy of ' || role, 'text': text}]) AS m
  FROM conversations)""")
def explode_messages(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.array(
            F.struct("role", "text"), F.struct(text("copy of ", F.col("role")).alias("role"), "text")
        ).alias("messages"),
    )
    return explode_container(rows, keep=("conv_id", "turn"))


# ------------------------------------------------------------------ masking


@query("SELECT c_custkey, '*****' AS c_name, c_mktsegment FROM customer")
def mask_fixed(spark, sf_dir):
    return mask(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_name")


@query("""
SELECT o_orderkey AS key, c_custkey AS customer_key, sha1(unhex(sha1(c_name))) AS customer_full_name,
       c_nationkey AS customer_home__nation, sha1(unhex(sha1(c_mktsegment))) AS customer_home__segment,
       o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey""")
def mask_sha1_nested(spark, sf_dir):
    rows = nested_orders(spark, sf_dir)
    return flatten(mask(rows, "customer.full name, customer.home#.segment", "sha1"))


@query("""
SELECT conv_id, turn, role, sha1(unhex(sha1(text))) AS text, sha1(unhex(sha1(role))) AS tag FROM conversations""")
def mask_list_elements(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array(F.struct("role", "text")).alias("messages"), F.array("role").alias("tags")
    )
    masked = mask(rows, ["messages.value.text", "tags.value"], "sha1")
    return masked.select(
        "conv_id", "turn", F.col("messages")[0]["role"].alias("role"),
        F.col("messages")[0]["text"].alias("text"), F.col("tags")[0].alias("tag"),
    )


def sha512_twice(name: str) -> str:
    return hashlib.sha512(hashlib.sha512(b"pepper" + name.encode()).digest()).hexdigest()


# The market segments of the customer table.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SEGMENT_MASKS = ", ".join(f"('{s}', '{sha512_twice(s)}')" for s in SEGMENTS)


@query(f"""
SELECT c_custkey, masked AS c_mktsegment FROM customer
LEFT JOIN (VALUES {SEGMENT_MASKS}) AS m(name, masked) ON c_mktsegment = name""")
def mask_sha512(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return mask(rows, "c_mktsegment", "sha512", salt="pepper")


@query("SELECT count(c_mktsegment) AS n, count(c_mktsegment) AS distinct_masks, 128 AS width FROM customer")
def mask_random_salt(spark, sf_dir):
    """Equal values must not share a mask."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("secret"))
    rows = mask(rows, "secret", "sha512", random_salt=True)
    return rows.groupBy("secret").agg(F.count("*").alias("n"), F.max(F.length("secret")).alias("w")).agg(
        F.sum("n").alias("n"), F.count("*").alias("distinct_masks"), F.max("w").alias("width")
    )


# ------------------------------------------------------------------ validation


def checked_rows(spark, sf_dir):
    rows = decode.decode_json(
        events_topic(spark, sf_dir, mixed_json()),
        T.StructType.fromDDL("user bigint, props struct<k: bigint>"),
        keep_raw="raw",
    )
    return validate_keys(rows, ["user"], column="value")


@query(TOPIC_SQL + """
SELECT "offset", user_id AS user, k FROM t WHERE "offset" % 8 IN (0, 7)""")
def split_valid(spark, sf_dir):
    valid, _ = split_invalid(checked_rows(spark, sf_dir))
    return valid.select("offset", "value.user", "value.props.k")


@query(TOPIC_SQL + f"""
SELECT topic, "partition", "offset", {MIXED_REASON_SQL} AS reason FROM t WHERE "offset" % 8 NOT IN (0, 7)""")
def dead_letters(spark, sf_dir):
    _, dead = split_invalid(checked_rows(spark, sf_dir))
    return dead.select("topic", "partition", "offset", "reason")


@query(TOPIC_SQL + """
SELECT "offset", 'missing key: customer' AS reason FROM t""")
def missing_key(spark, sf_dir):
    rows = validate_keys(decode.decode_json(events_topic(spark, sf_dir)), ["customer"], True, "value")
    return split_invalid(rows)[1].select("offset", "reason")


# ------------------------------------------------------------------ replay, segments, offsets


def seen_before(spark, sf_dir):
    """Committed offsets: what lies in the first two fifths of the events."""
    events = events_topic(spark, sf_dir)
    limit = events.agg(F.expr("(max(offset) * 2) div 5")).scalar()
    return (
        events.filter(F.col("offset") <= limit)
        .groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    )


COMMITTED_SQL = TOPIC_SQL + """
, done AS (SELECT topic, "partition", max("offset") AS last FROM t
  WHERE "offset" <= (SELECT max("offset") * 2 // 5 FROM t) GROUP BY topic, "partition")
"""


@query(COMMITTED_SQL + """
SELECT t.topic, t."partition", t."offset", t.props AS value FROM t LEFT JOIN done USING (topic, "partition")
WHERE done.last IS NULL OR t."offset" > done.last""")
def replay_filter(spark, sf_dir):
    rows = events_topic(spark, sf_dir)
    twice = rows.unionAll(rows)
    return drop_replayed(twice, seen_before(spark, sf_dir)).select("topic", "partition", "offset", "value")


@query(TOPIC_SQL + """
, a AS (SELECT topic, "partition", "offset" AS arrival, "offset" + ("offset" * 37) % 101 AS o FROM t),
m AS (SELECT *, max(o) OVER (PARTITION BY topic, "partition" ORDER BY arrival
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a)
SELECT topic, "partition", o AS "offset", arrival FROM m WHERE seen IS NULL OR o > seen""")
def replay_by_arrival(spark, sf_dir):
    rows = events_topic(spark, sf_dir).withColumn("arrival", F.col("offset"))
    rows = rows.withColumn("offset", F.col("offset") + (F.col("offset") * 37) % 101)
    return drop_replayed(rows, arrival="arrival").select("topic", "partition", "offset", "arrival")


RECORDS, BYTES, IDLE_MS = 100, 1000, 3_600_000
BY_TP = 'OVER (PARTITION BY topic, "partition" ORDER BY "offset")'
SEGMENT_COLUMNS = ("topic", "partition", "offset", "segment")


def value_size():
    return F.octet_length("value").cast("bigint")


def greedy_sql(condition: str, select: str) -> str:
    """Row by row, counters reset at every break: a recursive query."""
    return f"""WITH RECURSIVE {TOPIC_SQL.strip().removeprefix('WITH')},
o AS (SELECT *, ("offset" // 700) % 2 AS kind, row_number() {BY_TP} AS rn FROM t),
g AS (SELECT topic, "partition", rn, "offset", CAST(0 AS BIGINT) AS segment, CAST(1 AS BIGINT) AS n,
             CAST(size AS BIGINT) AS b, ms, kind FROM o WHERE rn = 1
  UNION ALL
  SELECT topic, "partition", rn, "offset", segment + brk, CASE brk WHEN 1 THEN 1 ELSE n + 1 END,
         CASE brk WHEN 1 THEN size ELSE b + size END, ms, kind
  FROM (SELECT o.topic, o."partition", o.rn, o."offset", o.size, o.ms, o.kind, g.segment, g.n, g.b,
               CASE WHEN {condition} THEN 1 ELSE 0 END AS brk
        FROM g JOIN o ON o.topic = g.topic AND o."partition" = g."partition" AND o.rn = g.rn + 1))
{select}"""


ALL_SEGMENTS = 'SELECT topic, "partition", "offset", segment FROM g'


@query(TOPIC_SQL + f"""
SELECT topic, "partition", "offset", (row_number() {BY_TP} - 1) // {RECORDS} AS segment FROM t""")
def segment_records(spark, sf_dir):
    return seg.segment(events_topic(spark, sf_dir), max_records=RECORDS).select(*SEGMENT_COLUMNS)


@query(greedy_sql(f"g.b >= {BYTES}", ALL_SEGMENTS))
def segment_bytes(spark, sf_dir):
    rows = seg.segment(events_topic(spark, sf_dir), max_bytes=BYTES, size=value_size())
    return rows.select(*SEGMENT_COLUMNS)


@query(TOPIC_SQL + f"""
, l AS (SELECT *, lag(ms) {BY_TP} AS before FROM t)
SELECT topic, "partition", "offset",
       CAST(sum(CASE WHEN ms - before >= {IDLE_MS} THEN 1 ELSE 0 END) {BY_TP} AS BIGINT) AS segment FROM l""")
def segment_idle(spark, sf_dir):
    return seg.segment(events_topic(spark, sf_dir), idle=IDLE_MS).select(*SEGMENT_COLUMNS)


@query(CHANGING_SQL + """SELECT topic, "partition", "offset", epoch AS segment FROM e""")
def segment_schema(spark, sf_dir):
    rows = events_topic(spark, sf_dir, changing_json())
    rows = rows.withColumn("shape", infer.json_shape(F.col("value")))
    return seg.segment(rows, by_schema="shape").select(*SEGMENT_COLUMNS)


@query(greedy_sql(f"g.b >= {BYTES} OR g.n >= {RECORDS} OR o.ms - g.ms >= {IDLE_MS} OR o.kind <> g.kind", ALL_SEGMENTS))
def segment_combined(spark, sf_dir):
    rows = events_topic(spark, sf_dir).withColumn("kind", F.expr("offset div 700") % 2)
    rows = seg.segment(rows, RECORDS, BYTES, IDLE_MS, "kind", size=value_size())
    return rows.select(*SEGMENT_COLUMNS)


MANIFEST_SQL = f"""
, s AS (SELECT *, (row_number() {BY_TP} - 1) // {RECORDS} AS segment FROM t),
m AS (SELECT topic, "partition", segment, min("offset") AS first_offset, max("offset") AS last_offset,
        CAST(sum(size) AS BIGINT) AS bytes, count(*) AS rows FROM s GROUP BY topic, "partition", segment),
manifest AS (SELECT *, rows >= {RECORDS} OR segment < max(segment) OVER (PARTITION BY topic, "partition") AS closed
  FROM m)
"""


def manifest_of(rows: DataFrame) -> DataFrame:
    return seg.segment_manifest(rows, value_size(), max_records=RECORDS).drop("last_ts")


@query(TOPIC_SQL + MANIFEST_SQL + """
SELECT topic, "partition", segment, first_offset, last_offset, bytes, rows, closed,
  'topic-' || topic || '_partition-' || "partition" || '_firstOffset-' || first_offset || '_lastOffset-' ||
  last_offset || '_bytes-' || bytes || '_rows-' || rows || '.parquet' AS file_name FROM manifest""")
def manifest(spark, sf_dir):
    return manifest_of(seg.segment(events_topic(spark, sf_dir), max_records=RECORDS))


@query(TOPIC_SQL + MANIFEST_SQL + """
SELECT topic, "partition", max(last_offset) AS "offset" FROM manifest WHERE closed GROUP BY topic, "partition" """)
def committed_offsets(spark, sf_dir):
    rows = seg.segment(events_topic(spark, sf_dir), max_records=RECORDS)
    return seg.committed_offsets(manifest_of(rows))


@query(TOPIC_SQL + MANIFEST_SQL + """
SELECT s.topic, s."partition", s."offset", manifest.closed FROM s JOIN manifest USING (topic, "partition", segment)""")
def closed_rows(spark, sf_dir):
    rows = seg.segment(events_topic(spark, sf_dir), max_records=RECORDS)
    return seg.mark_closed(rows, manifest_of(rows)).select("topic", "partition", "offset", "closed")


@query(TOPIC_SQL + MANIFEST_SQL + """
SELECT s.topic, s."partition", s."offset", s.props AS value FROM s JOIN manifest USING (topic, "partition", segment)
WHERE NOT manifest.closed""")
def resume(spark, sf_dir):
    rows = events_topic(spark, sf_dir)
    again = seg.resume(rows, manifest_of(seg.segment(rows, max_records=RECORDS)))
    return again.select("topic", "partition", "offset", "value")


# ------------------------------------------------------------------ sinks


@query(TOPIC_SQL + MANIFEST_SQL + """
SELECT topic, "partition", segment, "offset", props AS value FROM s""")
def segment_files(spark, sf_dir):
    """Write segments to Parquet and read them back; at 100 rows each they share files."""
    path = scratch(spark, "segments")
    rows = seg.segment(events_topic(spark, sf_dir), max_records=RECORDS).drop("timestamp")
    write_segments(rows, path, row_group_bytes=1 << 20, shared=True)
    schema = "value string, offset bigint, topic string, partition int, segment bigint"
    return spark.read.schema(schema).parquet(path)


@query("""
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def latest_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return latest.latest_per_key(rows, ["user_id"], "event_id")


@query("""
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       CASE WHEN arg_max(event_type, event_id) = 'click' THEN NULL ELSE arg_max(value, event_id) END AS value
FROM events GROUP BY user_id""")
def upsert(spark, sf_dir):
    """Clicks arrive without a value; both kinds go into one keyed table."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    path = scratch(spark, "keyed")
    upsert_table(spark, path, events.filter("event_type <> 'click'"), ["user_id"], "event_id", 0)
    upsert_table(spark, path, events.filter("event_type = 'click'").drop("value"), ["user_id"], "event_id", 1)
    return read_table(spark, path, 1)


@query("""
SELECT 'text' AS "column", count(*) AS rows, CAST(max(length(text)) AS INTEGER) AS longest FROM documents
WHERE length(text) > 500""")
def overlong_strings(spark, sf_dir):
    report = latest.overlong_strings(table(spark, sf_dir, "documents"), 500)
    return report.select("column", "rows", "longest")


# ------------------------------------------------------------------ whole ingest


FLOW_RECORDS = 400


def flow_options(**more) -> Options:
    return Options(
        keys="user_id", mask=Mask("user_kind", "sha1"), continue_on_invalid=True,
        max_records=FLOW_RECORDS, **more,
    )


def flow_json():
    """Event JSON in which every tenth user has no id."""
    return F.when(F.col("user_id") % 10 != 0, event_json()).otherwise(
        text('{"user":{"kind":"', F.col("event_type"), '"},"props":', F.col("props"), "}")
    )


FLOW_SQL = """
SELECT CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS user_id, sha1(unhex(sha1(topic))) AS user_kind,
  value AS amount, '["' || topic || '",' || user_id || ']' AS tags, k AS props_k,
  "partition" AS "kafkaPartition", "offset" AS "kafkaOffset", ms AS "kafkaTimestamp",
  "partition" || '_' || "offset" AS "kafkaPartitionOffset", "offset" AS "__order"
"""


@query(TOPIC_SQL + FLOW_SQL + " FROM t WHERE user_id % 10 <> 0")
def transform_full(spark, sf_dir):
    return transform(events_topic(spark, sf_dir, flow_json()), flow_options()).valid.select("value.*")


@query(TOPIC_SQL + """
SELECT topic, "partition", "offset", 'null key: user_id' AS reason FROM t WHERE user_id % 10 = 0""")
def transform_dead_letters(spark, sf_dir):
    dead = transform(events_topic(spark, sf_dir, flow_json()), flow_options()).dead_letters
    return dead.select("topic", "partition", "offset", "reason")


@query(TOPIC_SQL + f"""
, v AS (SELECT *, (row_number() {BY_TP} - 1) // {FLOW_RECORDS} AS segment,
          count(*) OVER (PARTITION BY topic, "partition") // {FLOW_RECORDS} AS full FROM t WHERE user_id % 10 <> 0)
""" + FLOW_SQL + ', "offset" AS "__offset", topic AS "__topic", "partition" AS "__partition", segment AS "__segment" FROM v WHERE segment < "full"')
def ingest_batch_rows(spark, sf_dir):
    """Closed segments only, published in two runs over a growing topic."""
    rows, path = events_topic(spark, sf_dir, flow_json()), scratch(spark, "batch")
    half = rows.agg(F.expr("max(offset) div 2")).first()[0]
    ingest_batch(spark, rows.filter(F.col("offset") <= half), path, flow_options())
    return ingest_batch(spark, rows, path, flow_options()).rows(lineage=True)


@query(TOPIC_SQL + """
SELECT "offset", 'longer than 9: name' AS reason, 'event-' || "offset" AS name FROM t
WHERE strlen('event-' || "offset") > 9""")
def width_dead_letters(spark, sf_dir):
    """Texts beyond the width of the target's columns."""
    value = text('{"name":"event-', F.col("event_id"), '"}')
    options = Options(varchar_length=9, embed_metadata=False, continue_on_invalid=True)
    dead = transform(events_topic(spark, sf_dir, value), options).dead_letters
    return dead.select("offset", "reason", F.get_json_object("value", "$.name").alias("name"))


@query(TOPIC_SQL + """
SELECT topic, "partition", "offset", '{"user":{"kind":"' || topic || '"},"props":' || props || '}' AS value,
  'null key: user_id' AS reason FROM t WHERE user_id % 10 = 0""")
def dead_letter_files(spark, sf_dir):
    """The dead-letter sink, read back."""
    path = scratch(spark, "dead")
    write_dead_letters(transform(events_topic(spark, sf_dir, flow_json()), flow_options()).dead_letters, path)
    return spark.read.parquet(path).select("topic", "partition", "offset", "value", "reason")


@query(TOPIC_SQL + """SELECT topic, "partition", "offset", ms, props AS value FROM t""")
def read_topic_rows(spark, sf_dir):
    """A topic stored as files, through the reader of topics."""
    path = scratch(spark, "topic")
    events_topic(spark, sf_dir).write.parquet(path)
    rows = read_topic(spark, "parquet", path=path)
    return rows.select("topic", "partition", "offset", F.unix_millis("timestamp").alias("ms"), "value")


@query(TOPIC_SQL + """
SELECT "offset", CASE "offset" % 4 WHEN 0 THEN 'payload is not an object' WHEN 1 THEN 'payload is not an object'
    WHEN 2 THEN 'payload is not an object' END AS reason,
  CASE "offset" % 4 WHEN 3 THEN user_id END AS id FROM t""")
def decode_top_level(spark, sf_dir):
    """JSON null, a number and a text are no records; fields that are always null are no columns."""
    number, user = F.col("event_id") % 4, F.col("user_id")
    value = (
        F.when(number == 0, F.lit("null")).when(number == 1, user.cast("string"))
        .when(number == 2, text('"', user, '"')).otherwise(text('{"id":', user, ',"nothing":null}'))
    )
    rows = decode.decode_json(events_topic(spark, sf_dir, value))
    return rows.select("offset", F.get("_invalid", F.lit(0)).alias("reason"), "value.*")


RANKED_SQL = """
, r AS (SELECT *, "offset" * 7919 % 101 AS rank,
          CASE WHEN "offset" <= (SELECT max("offset") // 2 FROM t) THEN 0 ELSE 1 END AS batch FROM t)
SELECT user_id, rank, topic AS kind, "offset" AS number FROM r
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY rank DESC, batch DESC, topic DESC, "partition" DESC, "offset" DESC) = 1"""


@query(TOPIC_SQL + RANKED_SQL)
def ingest_keyed_rows(spark, sf_dir):
    """Two batches, the second one twice, into one row per user: the highest rank stays, whenever it came."""
    number = F.col("event_id")
    value = text(
        '{"user_id":', F.col("user_id"), ',"rank":', number * 7919 % 101, ',"kind":"', F.col("event_type"),
        '","number":', number, "}",
    )
    rows, path = events_topic(spark, sf_dir, value), scratch(spark, "merged")
    half = rows.agg(F.expr("max(offset) div 2")).first()[0]
    options = Options(keys="user_id", order_by="rank", embed_metadata=False, table="users", buckets=16)
    publish(rows.filter(F.col("offset") <= half), 0, path, options)
    for _ in range(2):
        publish(rows.filter(F.col("offset") > half), 1, path, options)
    return Store(spark, path).latest(options)


@query(TOPIC_SQL + """
SELECT topic, "partition", "offset", CASE topic WHEN 'click' THEN NULL ELSE user_id END AS number,
  CASE topic WHEN 'click' THEN 'u' || user_id END AS name FROM t""")
def ingest_topic_schemas(spark, sf_dir):
    """Field ``id`` is text in one topic and a number in the others: a table per topic, no conflict."""
    value = F.when(F.col("event_type") == "click", text('{"id":"u', F.col("user_id"), '"}')).otherwise(
        text('{"id":', F.col("user_id"), "}")
    )
    options = Options(embed_metadata=False, schema_per_topic=True)
    rows = events_topic(spark, sf_dir, value)
    store = ingest_batch(spark, rows, scratch(spark, "topics"), options)
    frames = []
    for topic in sorted(r[0] for r in rows.select("topic").distinct().collect()):
        (version,) = store.versions_of(topic)
        found = store.rows(True, version)
        is_text = found.schema["id"].dataType == T.StringType()
        frames.append(
            found.select(
                *[F.col(f"__{c}").alias(c) for c in ("topic", "partition", "offset")],
                (F.lit(None).cast("bigint") if is_text else F.col("id")).alias("number"),
                (F.col("id") if is_text else F.lit(None).cast("string")).alias("name"),
            )
        )
    return reduce(DataFrame.unionAll, frames)


RETYPED_SQL = 'CASE WHEN "offset" // 500 % 3 = 1 THEN 1 ELSE 0 END'


@query(TOPIC_SQL + f"""
SELECT {RETYPED_SQL} AS version, topic, "partition", "offset",
  CASE {RETYPED_SQL} WHEN 1 THEN 'x' ELSE '' END || "offset" AS k FROM t""")
def ingest_conflict_rows(spark, sf_dir):
    """A field that turns from number to text and back; the text comes under a repeated key."""
    number = F.col("event_id")
    value = F.when(
        F.expr("event_id div 500 % 3 = 1"), text('{"k":', number, ',"k":"x', number, '"}')
    ).otherwise(text('{"k":', number, "}"))
    options = Options(embed_metadata=False)
    store = ingest_batch(spark, events_topic(spark, sf_dir, value), scratch(spark, "conflict"), options)
    versions = [
        store.rows(True, n).select(
            F.lit(n).alias("version"),
            *[F.col(f"__{c}").alias(c) for c in ("topic", "partition", "offset")],
            F.col("k").cast("string").alias("k"),
        )
        for n in range(len(store.schemas()))
    ]
    return reduce(DataFrame.unionAll, versions)


@query(TOPIC_SQL + f"""
, v AS (SELECT *, (row_number() {BY_TP} - 1) // {FLOW_RECORDS} AS segment FROM t WHERE user_id % 10 <> 0)
""" + FLOW_SQL + ', "offset" AS "__offset", topic AS "__topic", "partition" AS "__partition", segment AS "__segment" FROM v')
def ingest_stream_rows(spark, sf_dir):
    """The events file as a stream, published with open segments included."""
    path = scratch(spark, "stream")
    stream = as_events_topic(stream_of(spark, sf_dir, "events"), flow_json())
    ingest_stream(stream, f"{path}/out", flow_options(), f"{path}/checkpoint").awaitTermination()
    return Store(spark, f"{path}/out").rows(lineage=True)


def stream_of(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


@query(TOPIC_SQL + MANIFEST_SQL + """
SELECT topic, "partition", segment, first_offset, last_offset, bytes, rows FROM manifest WHERE closed""")
def closed_segments_stream(spark, sf_dir):
    """Four micro-batches of one growing topic.

    A topic grows in the order of its offsets, files of one write have no order: the stream
    goes on after each write, and takes all of its files as one micro-batch.
    """
    path, events = scratch(spark, "closed"), table(spark, sf_dir, "events")
    most = events.agg(F.max("event_id")).first()[0]
    options, size = Options(max_records=RECORDS), value_size()
    for i in range(4):
        some = events.filter(F.expr(f"event_id * 4 div {most + 1}") == i)
        some.write.mode("append").parquet(f"{path}/events")
        stream = as_events_topic(spark.readStream.schema(events.schema).parquet(f"{path}/events"))
        track_segments(stream, f"{path}/out", options, f"{path}/check", size).awaitTermination()
    closed = Store(spark, f"{path}/out").manifest(options).filter("closed")
    return closed.select("topic", "partition", "segment", "first_offset", "last_offset", "bytes", "rows")


@query(TOPIC_SQL + f"""
, l AS (SELECT *, lag(ms) OVER (PARTITION BY topic, "partition" ORDER BY ms) AS before FROM t),
s AS (SELECT *, sum(CASE WHEN ms - before >= {IDLE_MS} THEN 1 ELSE 0 END)
        OVER (PARTITION BY topic, "partition" ORDER BY ms) AS session FROM l)
SELECT topic, "partition", min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS rows
FROM s GROUP BY topic, "partition", session""")
def idle_session_rows(spark, sf_dir):
    rows = events_topic(spark, sf_dir)
    return idle_sessions(rows, f"{IDLE_MS}ms", "0 seconds").drop("session")
