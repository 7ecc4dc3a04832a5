"""Ingest, bulk files, table changes, scans and exports over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.functions import packing
from vecspark.functions import predicates as p
from vecspark.operators import export, scans
from vecspark.operators.distances import calc_distance, stored_vectors
from vecspark.operators.search import search
from vecspark.session import scratch_path
from vecspark.sources import files, ingest
from vecspark.sources.table import VectorTable
from workload.fixtures import CENTROIDS_SQL, L2_SQL, centroids, embeddings
from workload.registry import query, table

c = F.col
L, D, STR, TS = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def point(*cols):
    """A two- or more-dimensional vector from numeric columns, so that every table has its vector field."""
    return F.array(*[F.col(x).cast("float") for x in cols])


def orders(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumn("vec", point("o_totalprice", "o_custkey"))


def order_schema(dynamic=False, **flags):
    fields = [S.field("o_orderkey", L, pk=True), S.field("o_custkey", L, **flags), S.field("o_orderstatus", STR, max_length=10),
              S.field("o_totalprice", D), S.field("o_orderpriority", STR, max_length=20), S.vector("vec", "dense", 2)]
    return S.table_schema(fields, dynamic)


PLAIN = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "vec"]
SHOWN = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
SHOWN_SQL = ", ".join(SHOWN)


def new_table(spark, schema, **kw):
    return VectorTable.create(spark, scratch_path(spark, "table"), schema, **kw)


def order_table(spark, sf, **flags):
    t = new_table(spark, order_schema(**flags))
    t.insert(orders(spark, sf).select(*PLAIN), sealed=True)
    return t


# ---------------------------------------------------------------- ingest

@query("ingest_validated", f"SELECT {SHOWN_SQL} FROM orders")
def ingest_validated(spark, sf):
    t = new_table(spark, order_schema())
    ingest.ingest(t, orders(spark, sf).select(*PLAIN))
    return t.read().select(*SHOWN)


@query("ingest_violations", """SELECT doc_id, 'tokens:capacity' AS rule FROM documents WHERE len(string_split(text, ' ')) > 200
UNION ALL SELECT doc_id, 'text:max_length' FROM documents WHERE strlen(text) > 2000
UNION ALL SELECT doc_id, 'lang:missing' FROM documents WHERE source = 'src3'
UNION ALL SELECT doc_id, 'terms:order' FROM documents WHERE lang = 'de' AND len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> ''))) > 1
UNION ALL SELECT doc_id, 'point:dim' FROM documents WHERE lang = 'fr'""")
def ingest_violations(spark, sf):
    from vecspark.functions.packing import term_vector

    d = table(spark, sf, "documents")
    schema = S.table_schema([
        S.field("doc_id", L, pk=True), S.field("text", STR, max_length=2000), S.field("lang", STR),
        S.field("tokens", T.ArrayType(STR), max_capacity=200), S.vector("terms", "sparse"), S.vector("point", "dense", 2)])
    # whole-table batch with faults: reversed entries in one language, short points in another, nulls in a source
    terms = term_vector("text")
    number = c("n_chars").cast("float")
    batch = d.select(
        "doc_id", "text", F.when(c("source") != "src3", c("lang")).alias("lang"), F.split("text", " ", -1).alias("tokens"),
        terms.alias("terms"), c("lang").alias("l"), F.when(c("lang") == "fr", F.array(number)).otherwise(F.array(number, number)).alias("point"))
    batch = batch.withColumn("terms", F.when(c("l") == "de", F.reverse("terms")).otherwise(c("terms"))).drop("l")
    return ingest.violations(batch, schema)


@query("ingest_fill_defaults", """SELECT c_custkey, c_name, 'new' AS c_state, NULL::varchar AS c_note,
  coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, 'none') AS c_mktsegment FROM customer""")
def ingest_fill_defaults(spark, sf):
    schema = S.table_schema([
        S.field("c_custkey", L, pk=True), S.field("c_name", STR), S.field("c_state", STR, default="new"),
        S.field("c_note", STR, nullable=True), S.field("c_mktsegment", STR, default="none"), S.vector("vec", "dense", 2)])
    batch = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(c("c_mktsegment") != "BUILDING", c("c_mktsegment")).alias("c_mktsegment"),
        point("c_acctbal", "c_nationkey").alias("vec"))
    t = new_table(spark, schema)
    ingest.ingest(t, batch)
    return t.read().select("c_custkey", "c_name", "c_state", "c_note", "c_mktsegment")


def dynamic_orders(spark, sf):
    """Orders with only key, price and vector declared; status, priority and customer are dynamic."""
    schema = S.table_schema([S.field("o_orderkey", L, pk=True), S.field("o_totalprice", D), S.vector("vec", "dense", 2)], dynamic=True)
    t = new_table(spark, schema)
    ingest.ingest(t, orders(spark, sf).select(*PLAIN))
    return t


@query("ingest_dynamic", f"SELECT {SHOWN_SQL} FROM orders")
def ingest_dynamic(spark, sf):
    r = dynamic_orders(spark, sf).read()
    typed = lambda n, t: p.dynamic_typed(r, n, t).alias(n)
    return r.select("o_orderkey", typed("o_custkey", "int"), typed("o_orderstatus", "string"), "o_totalprice",
                    typed("o_orderpriority", "string"))


def event_table(spark, sf):
    schema = S.table_schema([S.field("event_id", L, pk=True), S.field("value", D), S.vector("vec", "dense", 2)], dynamic=True)
    t = new_table(spark, schema)
    e = table(spark, sf, "events")
    ingest.ingest(t, e.select("event_id", "value", point("value", "user_id").alias("vec"), F.parse_json("props").alias(p.META)))
    return t


@query("ingest_dynamic_explicit", "SELECT event_id, regexp_extract(props, '[0-9]+')::bigint AS k FROM events")
def ingest_dynamic_explicit(spark, sf):
    r = event_table(spark, sf).read()
    return r.select("event_id", p.dynamic_typed(r, "k", "int").alias("k"))


@query("ingest_autoid", "SELECT 1000 + row_number() OVER (ORDER BY ts, event_id) AS id, event_id FROM events")
def ingest_autoid(spark, sf):
    return ingest.with_row_ids(table(spark, sf, "events").select("ts", "event_id"), "id", ["ts", "event_id"], start=1001).select("id", "event_id")


@query("ingest_autoid_hash", "SELECT count(*)::bigint AS rows, count(*)::bigint AS ids FROM events")
def ingest_autoid_hash(spark, sf):
    made = ingest.with_hash_ids(table(spark, sf, "events"), "id", "batch-1", ["event_id"])
    return made.agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"))


@query("ingest_rows", """SELECT event_id, value, event_type, regexp_extract(props, '[0-9]+')::bigint AS k FROM events""")
def ingest_rows(spark, sf):
    """Events written as JSON lines and read as rows: two keys are undeclared and become dynamic."""
    path = scratch_path(spark, "json")
    k = F.get_json_object("props", "$.k").cast("bigint")
    table(spark, sf, "events").select("event_id", "value", point("value", "user_id").alias("vec"), "event_type", k.alias("k")).write.json(path)
    schema = S.table_schema([S.field("event_id", L, pk=True), S.field("value", D), S.vector("vec", "dense", 2)], dynamic=True)
    t = new_table(spark, schema)
    ingest.ingest(t, ingest.rows_from_json(spark.read.text(path), schema))
    r = t.read()
    return r.select("event_id", "value", p.dynamic_typed(r, "event_type", "string").alias("event_type"), p.dynamic_typed(r, "k", "int").alias("k"))


@query("ingest_infer_schema", """SELECT * FROM (VALUES ('embedding', 'array<float>', 64), ('label', 'bigint', 0), ('vec_id', 'bigint', 0)) v(field, type, dim)
WHERE EXISTS (SELECT 1 FROM embeddings)""")
def ingest_infer_schema(spark, sf):
    path = scratch_path(spark, "json")
    embeddings(spark, sf).write.json(path)
    found = ingest.infer_schema(spark, path, "vec_id")
    rows = [(f.name, f.dataType.simpleString(), f.metadata.get("dim", 0)) for f in found.fields]
    return spark.createDataFrame(rows, "field string, type string, dim int")


@query("ingest_infer_schema_kinds", """WITH k AS (SELECT * FROM (VALUES ('bits', 'bits', 64), ('embedding', 'dense', 64),
 ('half', 'fp16', 64), ('label', 'bigint', 0), ('mixed', 'double', 0), ('sparse', 'sparse', 0), ('vec_id', 'bigint', 0)) v(field, kind, dim))
SELECT field, kind, dim, (SELECT count(*) FROM embeddings)::bigint AS rows FROM k WHERE EXISTS (SELECT 1 FROM embeddings)""")
def ingest_infer_schema_kinds(spark, sf):
    """All vector kinds as JSON lines: the schema is inferred and every line is read back with it."""
    path = scratch_path(spark, "json")
    sparse = F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("bigint").alias("i"), x.alias("v"))), lambda e: e["v"] > 0)
    mixed = F.when(F.col("vec_id") % 2 == 0, "7").otherwise("7.5")
    made = embeddings(spark, sf).select("vec_id", "label", "embedding", packing.pack_bits("embedding", 64).alias("bits"),
                                        packing.pack_fp16("embedding").alias("half"), sparse.alias("sparse"), mixed.alias("mixed"))
    line = F.regexp_replace(F.to_json(F.struct(*made.columns)), '"mixed":"([0-9.]+)"', '"mixed":$1')
    made.select(line.alias("value")).write.text(path)
    found = ingest.infer_schema(spark, path, "vec_id", vectors={"bits": "bits", "half": "fp16"})
    rows = ingest.rows_from_json(spark.read.text(path), found)
    broken = F.count_if(F.size(F.filter(F.array(*[bad for _, bad in ingest.rules(found)]), lambda b: b)) > 0)
    kinds = [F.struct(F.lit(f.name).alias("field"), F.lit(f.metadata.get("encoding", f.dataType.simpleString())).alias("kind"),
                      F.lit(f.metadata.get("dim", 0)).alias("dim")) for f in found.fields]
    return rows.agg((F.count("*") - broken).alias("rows")).select(F.inline(F.array(*kinds)), "rows")


# ---------------------------------------------------------------- bulk files

def part_schema():
    return T.StructType([T.StructField("p_partkey", L), T.StructField("p_brand", STR), T.StructField("p_size", T.IntegerType()),
                         T.StructField("p_retailprice", D)])


@query("bulk_load", "SELECT f.fmt AS fmt, p_partkey, p_brand, p_size, p_retailprice FROM part, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(fmt)")
def bulk_load(spark, sf):
    out = None
    for fmt in ("csv", "json", "orc", "parquet"):
        path = scratch_path(spark, "bulk") + f".{fmt}"
        rows = table(spark, sf, "part").select(*part_schema().names)
        rows.write.options(**({"header": True} if fmt == "csv" else {})).format(fmt).save(path)
        back = files.bulk_load(spark, path, part_schema()).withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


@query("bulk_load_window", "SELECT event_id FROM events WHERE ts >= '2024-01-10' AND ts <= '2024-01-20 12:00:00'")
def bulk_load_window(spark, sf):
    window = files.in_window(table(spark, sf, "events"), "ts", F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-20 12:00:00").cast("timestamp"))
    return window.select("event_id")


@query("bulk_load_report", "SELECT 'orders.parquet' AS file, count(*)::bigint AS rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders")
def bulk_load_report(spark, sf):
    return files.load_report(table(spark, sf, "orders"), "o_orderkey")


@query("load_csv_vectors", """SELECT vec_id, label, round(embedding[1]::double, 5) AS first, round(embedding[64]::double, 5) AS last
FROM embeddings WHERE label NOT IN (3, 4)""")
def load_csv_vectors(spark, sf):
    """Embeddings as CSV with bracketed vectors; one label loses a dimension, one gets a broken key."""
    path = scratch_path(spark, "csv")
    e = embeddings(spark, sf)
    kept = F.when(c("label") == 3, F.slice("embedding", 1, 63)).otherwise(c("embedding"))
    text = F.concat(F.lit("["), F.array_join(kept.cast("array<string>"), ", "), F.lit("]"))
    key = F.when(c("label") == 4, F.lit("n/a")).otherwise(c("vec_id").cast("string"))
    e.select(key.alias("vec_id"), "label", text.alias("embedding")).write.csv(path)
    schema = T.StructType([T.StructField("vec_id", L), T.StructField("label", T.IntegerType()), T.StructField("embedding", S.FLOAT_VECTOR)])
    rows = files.load_csv_vectors(spark, path, schema, "embedding", 64)
    at = lambda i: F.round(F.get("embedding", F.lit(i)).cast("double"), 5)
    return rows.select("vec_id", "label", at(0).alias("first"), at(63).alias("last"))


# ---------------------------------------------------------------- partitions and layout

def customer_table(spark, sf):
    schema = S.table_schema([S.field("c_custkey", L, pk=True), S.field("c_acctbal", D), S.field("c_mktsegment", STR), S.vector("vec", "dense", 2)])
    t = new_table(spark, schema)
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", point("c_acctbal", "c_nationkey").alias("vec"))
    t.insert(rows, c("c_mktsegment"), sealed=True)
    return t


@query("write_partition", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def write_partition(spark, sf):
    return customer_table(spark, sf).read(["BUILDING"]).select("c_custkey", "c_mktsegment")


@query("list_partitions", "SELECT c_mktsegment AS _partition, count(*)::bigint AS rows FROM customer GROUP BY 1")
def list_partitions(spark, sf):
    return customer_table(spark, sf).list_partitions()


@query("drop_partition", "SELECT c_mktsegment AS _partition, count(*)::bigint AS rows FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def drop_partition(spark, sf):
    t = customer_table(spark, sf)
    t.drop_partition("BUILDING")
    return t.list_partitions()


@query("query_partitions", "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0")
def query_partitions(spark, sf):
    return scans.query(customer_table(spark, sf).read(["BUILDING", "MACHINERY"]), "c_acctbal > 0", ["c_custkey", "c_acctbal"])


@query("delete_in_partition", "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND c_acctbal < 1000)")
def delete_in_partition(spark, sf):
    t = customer_table(spark, sf)
    t.delete_by_filter("c_acctbal < 1000", "BUILDING")
    return t.read().select("c_custkey", "c_mktsegment")


@query("write_partition_key", "SELECT o_custkey, count(*)::bigint AS rows FROM orders GROUP BY 1")
def write_partition_key(spark, sf):
    return order_table(spark, sf, partition_key=True).read().groupBy("o_custkey").agg(F.count("*").alias("rows"))


@query("f_partition_key", "SELECT o_orderkey FROM orders WHERE o_custkey IN (1, 5, 42, 77) AND o_totalprice > 50000")
def f_partition_key(spark, sf):
    return order_table(spark, sf, partition_key=True).read_key([1, 5, 42, 77]).where("o_totalprice > 50000").select("o_orderkey")


@query("write_clustering_key", "SELECT l_orderkey, l_linenumber, count(*)::bigint AS rows FROM lineitem WHERE l_shipdate < '1996-01-01' GROUP BY 1, 2")
def write_clustering_key(spark, sf):
    schema = S.table_schema([S.field("id", L, pk=True), S.field("l_orderkey", L), S.field("l_linenumber", T.IntegerType()),
                             S.field("l_shipdate", TS, clustering_key=True), S.vector("vec", "dense", 2)])
    t = new_table(spark, schema)
    rows = table(spark, sf, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey").alias("id"), "l_orderkey", "l_linenumber",
        c("l_shipdate").cast("timestamp").alias("l_shipdate"), point("l_quantity", "l_discount").alias("vec"))
    t.insert(rows)
    old = t.read().where(c("l_shipdate") < F.lit("1996-01-01").cast("timestamp"))
    return old.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- table changes

@query("upsert", f"""SELECT {SHOWN_SQL.replace('o_totalprice', "CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice")} FROM orders
UNION ALL SELECT -1 - c_custkey, c_custkey, 'N', c_acctbal, 'new' FROM customer""")
def upsert(spark, sf):
    """Finished orders get a new price; one new order per customer."""
    t = order_table(spark, sf)
    changed = orders(spark, sf).where("o_orderstatus = 'F'").withColumn("o_totalprice", c("o_totalprice") + 1).select(*PLAIN)
    fresh = table(spark, sf, "customer").select(
        (F.lit(-1) - c("c_custkey")).alias("o_orderkey"), c("c_custkey").alias("o_custkey"), F.lit("N").alias("o_orderstatus"),
        c("c_acctbal").alias("o_totalprice"), F.lit("new").alias("o_orderpriority"), point("c_acctbal", "c_custkey").alias("vec"))
    t.upsert(changed.unionByName(fresh))
    return t.read().select(*SHOWN)


@query("upsert_last_wins", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events) WHERE n = 1""")
def upsert_last_wins(spark, sf):
    """All events as one batch keyed by user: the latest row per key stays."""
    schema = S.table_schema([S.field("user_id", L, pk=True), S.field("event_id", L), S.field("event_type", STR), S.vector("vec", "dense", 2)])
    t = new_table(spark, schema)
    batch = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts", point("value", "user_id").alias("vec"))
    t.upsert(batch, seq="ts")
    return t.read().select("user_id", "event_id", "event_type")


@query("upsert_dynamic", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderstatus = 'O' THEN 'seen' END AS note FROM orders""")
def upsert_dynamic(spark, sf):
    """The dynamic part is replaced as a whole: keys absent from the new row vanish."""
    t = dynamic_orders(spark, sf)
    batch = orders(spark, sf).where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice", "vec", F.lit("seen").alias("note"))
    t.upsert(batch)
    r = t.read()
    return r.select("o_orderkey", p.dynamic_typed(r, "o_orderpriority", "string").alias("o_orderpriority"), p.dynamic_typed(r, "note", "string").alias("note"))


@query("upsert_partition", """SELECT c_custkey, c_acctbal FROM customer
UNION ALL SELECT c_custkey, 0.0::double FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def upsert_partition(spark, sf):
    """Keys of all other segments upserted into one partition leave the other partitions' rows alone."""
    t = customer_table(spark, sf)
    rows = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")
    t.upsert(rows.select("c_custkey", F.lit(0.0).alias("c_acctbal"), "c_mktsegment", point("c_acctbal", "c_nationkey").alias("vec")), "BUILDING")
    return t.read().select("c_custkey", "c_acctbal")


@query("upsert_partition_key", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey + 100000 ELSE o_custkey END AS o_custkey FROM orders")
def upsert_partition_key(spark, sf):
    """A changed partition key moves the row: the primary key stays unique across the table."""
    t = order_table(spark, sf, partition_key=True)
    t.upsert(orders(spark, sf).where("o_orderstatus = 'P'").withColumn("o_custkey", c("o_custkey") + 100000).select(*PLAIN))
    return t.read().select("o_orderkey", "o_custkey")


@query("delete_by_pk", f"SELECT {SHOWN_SQL} FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_by_pk(spark, sf):
    t = order_table(spark, sf)
    t.delete_by_pk(table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(c("l_orderkey").alias("o_orderkey")))
    return t.read().select(*SHOWN)


@query("delete_by_filter", f"SELECT {SHOWN_SQL} FROM orders WHERE NOT (o_totalprice < 200000 AND o_orderstatus = 'F')")
def delete_by_filter(spark, sf):
    t = order_table(spark, sf)
    t.delete_by_filter("o_totalprice < 200000 AND o_orderstatus = 'F'")
    return t.read().select(*SHOWN)


@query("dml_count_chain", """SELECT step, rows FROM (
  SELECT 'insert' AS step, count(*)::bigint AS rows FROM orders UNION ALL
  SELECT 'insert more', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) UNION ALL
  SELECT 'delete', (SELECT count(*) FROM orders) UNION ALL
  SELECT 'insert again', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) UNION ALL
  SELECT 'upsert', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) UNION ALL
  SELECT 'compact', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer))""")
def dml_count_chain(spark, sf):
    t = order_table(spark, sf)
    counts = [t.row_count().withColumn("step", F.lit("insert"))]
    fresh = table(spark, sf, "customer").select(
        (F.lit(-1) - c("c_custkey")).alias("o_orderkey"), c("c_custkey").alias("o_custkey"), F.lit("N").alias("o_orderstatus"),
        c("c_acctbal").alias("o_totalprice"), F.lit("new").alias("o_orderpriority"), point("c_acctbal", "c_custkey").alias("vec"))
    steps = [("insert more", lambda: t.insert(fresh)), ("delete", lambda: t.delete_by_pk(fresh.select("o_orderkey"))),
             ("insert again", lambda: t.insert(fresh)), ("upsert", lambda: t.upsert(fresh)), ("compact", t.compact)]
    for name, change in steps:
        change()
        counts.append(t.row_count().withColumn("step", F.lit(name)))
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out.select("step", c("row_count").alias("rows"))


@query("compact", f"SELECT {SHOWN_SQL}, 1::bigint AS folders FROM orders")
def compact(spark, sf):
    """One insert per status, then merged: same rows, one folder."""
    t = new_table(spark, order_schema())
    for status in ("F", "O", "P"):
        t.insert(orders(spark, sf).where(c("o_orderstatus") == status).select(*PLAIN))
    t.compact()
    folders = sum(1 for e in t.entries() if e.seg)
    return t.read().select(*SHOWN, F.lit(folders).cast("bigint").alias("folders"))


@query("compact_plan", "SELECT '_default' AS _partition, 0::bigint AS target, true AS complete FROM orders LIMIT 1")
def compact_plan(spark, sf):
    t = new_table(spark, order_schema())
    for status in ("F", "O", "P"):
        t.insert(orders(spark, sf).where(c("o_orderstatus") == status).select(*PLAIN))
    plan = t.compact_plan(1 << 30)
    files_per_partition = t.file_stats().groupBy("_partition").agg(F.count("*").alias("files"))
    return plan.join(files_per_partition, "_partition").select("_partition", "target", (F.size("sources") == c("files")).alias("complete"))


@query("expire_ttl", "SELECT event_id, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 864000 SECOND")
def expire_ttl(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    schema = S.table_schema([S.field("event_id", L, pk=True), S.field("ts", TS), S.field("value", D), S.vector("vec", "dense", 2)])
    t = new_table(spark, schema)
    t.insert(e.withColumn("vec", point("value", "user_id")))
    now = e.agg(F.max("ts")).first()[0]
    t.expire("ts", 864000, F.lit(now))
    return t.read().select("event_id", "value")


# ---------------------------------------------------------------- scans and lookups

@query("query_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'O'")
def query_filter(spark, sf):
    return scans.query(table(spark, sf, "orders"), "o_totalprice > 400000 AND o_orderstatus = 'O'", ["o_orderkey", "o_totalprice"])


@query("query_limit_offset", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100 OFFSET 50")
def query_limit_offset(spark, sf):
    return scans.query(table(spark, sf, "orders"), "o_orderstatus = 'F'", ["o_orderkey", "o_totalprice"], order="o_orderkey", limit=100, offset=50)


@query("query_by_pks", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def query_by_pks(spark, sf):
    ids = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return scans.query_by_ids(table(spark, sf, "lineitem"), ids, "l_orderkey").select("l_orderkey", "l_linenumber", "l_quantity")


@query("get_rows", f"SELECT {SHOWN_SQL} FROM orders WHERE o_orderkey IN (SELECT c_custkey FROM customer)")
def get_rows(spark, sf):
    keys = table(spark, sf, "customer").select(c("c_custkey").alias("o_orderkey"))
    return order_table(spark, sf).read().transform(lambda r: scans.get(r, keys, "o_orderkey")).select(*SHOWN)


@query("count_star", "SELECT count(*)::bigint AS count FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'A'")
def count_star(spark, sf):
    return scans.count(table(spark, sf, "lineitem"), "l_quantity < 10 AND l_returnflag = 'A'")


@query("project_wildcard", "SELECT event_id, value, regexp_extract(props, '[0-9]+')::double AS k FROM events")
def project_wildcard(spark, sf):
    return scans.project(event_table(spark, sf).read(), ["*", "k", "value"]).drop("vec", p.META)


@query("project_dynamic", "SELECT event_id, regexp_extract(props, '[0-9]+')::double AS k FROM events WHERE regexp_extract(props, '[0-9]+')::int > 80")
def project_dynamic(spark, sf):
    r = event_table(spark, sf).read()
    return scans.query(r, p.field(r, "k") > 80, ["event_id", "k"])


@query("dynamic_typed", "SELECT event_id, regexp_extract(props, '[0-9]+')::bigint AS k_int, regexp_extract(props, '[0-9]+')::double AS k_double, NULL::varchar AS k_string FROM events")
def dynamic_typed(spark, sf):
    r = event_table(spark, sf).read()
    return r.select("event_id", p.dynamic_typed(r, "k", "int", strict=True).alias("k_int"), p.dynamic_typed(r, "k", "double").alias("k_double"),
                    p.dynamic_typed(r, "k", "string").alias("k_string"))


@query("cast_numeric", "SELECT p_partkey, p_size::bigint AS p_size, p_retailprice::float::double AS price FROM part")
def cast_numeric(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", c("p_retailprice").cast("float").alias("price"))
    return scans.widen(part)


@query("load_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def load_columns(spark, sf):
    return scans.load_columns(dynamic_orders(spark, sf).read(), ["o_orderkey", "o_totalprice"])


@query("table_stats", "SELECT count(*)::bigint AS row_count FROM orders")
def table_stats(spark, sf):
    return order_table(spark, sf).row_count()


@query("file_stats", "SELECT c_mktsegment AS _partition, count(*)::bigint AS rows FROM customer GROUP BY 1")
def file_stats(spark, sf):
    return customer_table(spark, sf).file_stats().groupBy("_partition").agg(F.sum("rows").alias("rows"))


def growing_table(spark, sf):
    """Finished and partial orders are compacted, open orders arrive later."""
    t = new_table(spark, order_schema())
    t.insert(orders(spark, sf).where("o_orderstatus <> 'O'").select(*PLAIN))
    t.compact()
    t.insert(orders(spark, sf).where("o_orderstatus = 'O'").select(*PLAIN))
    return t


@query("query_base_delta", f"""SELECT 'all' AS scope, {SHOWN_SQL} FROM orders WHERE o_totalprice > 100000
UNION ALL SELECT 'sealed', {SHOWN_SQL} FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'O'""")
def query_base_delta(spark, sf):
    t = growing_table(spark, sf)
    both = t.read().withColumn("scope", F.lit("all"))
    return both.unionByName(t.read(ignore_growing=True).withColumn("scope", F.lit("sealed"))).where("o_totalprice > 100000").select("scope", *SHOWN)


@query("scalar_layout", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 90000")
def scalar_layout(spark, sf):
    """A sorted layout with bloom filters answers as the plain files do."""
    path = scratch_path(spark, "layout")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    scans.write_scalar_layout(rows, path, "l_extendedprice", bloom=["l_orderkey"])
    return spark.read.parquet(path).where("l_extendedprice > 90000")


@query("knn_partitions", f"""WITH {CENTROIDS_SQL},
s AS (SELECT q.qid, e.vec_id, {L2_SQL} AS score FROM q, embeddings e WHERE e.label IN (1, 4, 6)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS rank FROM s)
SELECT qid, rank::bigint AS rank, vec_id, round(score, 4) AS score FROM r WHERE rank <= 10""")
def knn_partitions(spark, sf):
    """Vectors stored in one partition per label, searched in three of them."""
    t = new_table(spark, S.table_schema([S.field("vec_id", L, pk=True), S.vector("embedding", "dense", 64)]))
    t.insert(embeddings(spark, sf), F.concat(F.lit("label "), c("label").cast("string")))
    hits = search(t.read(["label 1", "label 4", "label 6"]), centroids(spark, sf), 10, metric="L2", pk="vec_id")
    return hits.withColumn("score", F.round("score", 4))


@query("calc_distance_ids", f"""WITH {CENTROIDS_SQL}
SELECT e.vec_id AS vec_id, q.qid AS right_id, round({L2_SQL}, 5) AS distance FROM embeddings e, q
WHERE e.vec_id IN (SELECT doc_id FROM labels)""")
def calc_distance_ids(spark, sf):
    """The left side is given as ids: the stored vectors of all labelled numbers."""
    ids = table(spark, sf, "labels").select(c("doc_id").alias("vec_id"))
    left = stored_vectors(ids, embeddings(spark, sf), "vec_id", "embedding")
    right = centroids(spark, sf).withColumnRenamed("qid", "right_id")
    pairs = calc_distance(left, right, "L2", left=("vec_id", "embedding"), right=("right_id", "qvec"))
    return pairs.withColumn("distance", F.round("distance", 5))


# ---------------------------------------------------------------- exports

@query("export_batches", """SELECT o_orderkey, row_no, ((row_no - 1) // 1000)::bigint AS batch_no FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_no FROM orders WHERE o_orderstatus <> 'P')""")
def export_rows(spark, sf):
    ready = export.export_batches(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 1000, "o_orderstatus <> 'P'")
    path = scratch_path(spark, "export")
    export.write_batches(ready.drop("o_orderstatus"), path, "o_orderkey")
    return spark.read.schema("o_orderkey bigint, row_no bigint, batch_no bigint").parquet(path)


@query("search_export", f"""WITH {CENTROIDS_SQL},
s AS (SELECT q.qid, e.vec_id, {L2_SQL} AS score FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS rank FROM s)
SELECT qid, rank, vec_id, round(score, 4) AS score, ((rank - 1) // 100)::bigint AS batch_no FROM r""")
def search_export(spark, sf):
    hits = export.search_export(embeddings(spark, sf), centroids(spark, sf), metric="L2", vec="embedding", pk="vec_id", size=100)
    return hits.select("qid", "rank", "vec_id", F.round("score", 4).alias("score"), "batch_no")


@query("search_export_pages", f"""WITH {CENTROIDS_SQL},
s AS (SELECT q.qid, e.vec_id, {L2_SQL} AS score FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS rank FROM s)
SELECT qid, rank, vec_id, round(score, 4) AS score, ((rank - 1) // 10)::bigint AS batch_no FROM r WHERE (rank - 1) // 10 BETWEEN 2 AND 4""")
def search_export_pages(spark, sf):
    """The third to fifth page of ten; rows far from their ranks are never shuffled."""
    hits = export.search_export(embeddings(spark, sf), centroids(spark, sf), metric="L2", vec="embedding", pk="vec_id", size=10, batches=(2, 4))
    return hits.select("qid", "rank", "vec_id", F.round("score", 4).alias("score"), "batch_no")


