"""Predicate queries: scalar, JSON, dynamic and array fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.functions import predicates as p
from vecspark.session import materialize
from workload.registry import query, table

# One JSON value per event.  click: object with a list; view: object with a null list; error: object with
# one key; purchase: a bare whole number or fraction; signup: a bare text or list.
J_SQL = """WITH j AS (SELECT event_id, event_type, value, regexp_extract(props, '[0-9]+')::int AS k FROM events)
SELECT event_id FROM j WHERE """


def json_events(spark, sf):
    k = F.get_json_object("props", "$.k")
    obj = lambda **kv: F.to_json(F.struct(*[v.alias(n) for n, v in kv.items()]), {"ignoreNullFields": "false"})
    pair = F.concat(F.lit("["), k, F.lit(", "), (k.cast("int") + 1).cast("string"), F.lit("]"))
    cheap = F.col("value") < 20
    text = (
        F.when(F.col("event_type") == "click", obj(number=k.cast("int"), string=k, bool=F.lit(False),
                                                   list=F.array(k.cast("int"), k.cast("int") + 1)))
        .when(F.col("event_type") == "view", obj(number=F.lit(0), string=k, bool=F.lit(True), list=F.lit(None).cast("array<int>")))
        .when(F.col("event_type") == "error", obj(string=k))
        .when(F.col("event_type") == "purchase", F.when(cheap, k).otherwise(F.concat(k, F.lit(".5"))))
        .when(cheap, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(pair))
    # stored as a JSON field: parsed once, not once per mention in a predicate
    return materialize(table(spark, sf, "events").select("event_id", F.parse_json(text).alias("json")), "json")


def json_query(name, sql, predicate):
    @query(name, J_SQL + sql)
    def run(spark, sf):
        return json_events(spark, sf).where(predicate()).select("event_id")


NUM = "(event_type = 'purchase')"
json_query("f_json_path_num", "event_type = 'click' AND k < 50 AND k <> 0",
           lambda: (p.j_num("json", "number") < 50) & p.j_ne("json", 0, "number"))
json_query("f_json_path_str", "event_type IN ('click', 'view', 'error') AND k IN (1, 2, 5)",
           lambda: p.j_in("json", ["1", "2", "5"], "string"))
json_query("f_json_path_bool", "event_type = 'view'", lambda: p.j_eq("json", True, "bool"))
json_query("f_json_path_list", "event_type = 'click' AND (k = 1 OR k < 10)",
           lambda: p.j_eq("json", [1, 2], "list") | (p.j_num("json", "list", 0) < 10))
json_query("f_json_whole", "(event_type = 'purchase' AND k + CASE WHEN value < 20 THEN 0 ELSE 0.5 END > 49.5) OR "
           "(event_type = 'signup' AND value < 20 AND k::varchar LIKE '2%') OR "
           "(event_type = 'signup' AND value >= 20 AND (k = 3 OR k > 90))",
           lambda: (p.j_num("json") > 49.5) | p.j_str("json").like("2%") | p.j_eq("json", [3, 4]) | (p.j_num("json", 0) > 90))
# no number equals a text: only the JSON texts themselves match
@query("f_json_type_strict", J_SQL.replace("SELECT event_id FROM j WHERE ", """SELECT event_type,
count(*) FILTER (event_type = 'signup' AND value < 20 AND k < 10)::bigint AS matches FROM j GROUP BY event_type"""))
def f_json_type_strict(spark, sf):
    """Matches per event type, types without any included."""
    texts = [str(k) for k in range(10)]
    hit = p.j_in("json", texts, "number") | p.j_in("json", texts)
    kinds = table(spark, sf, "events").select("event_id", "event_type")
    marked = json_events(spark, sf).select("event_id", F.coalesce(hit, F.lit(False)).alias("hit"))
    return kinds.join(marked, "event_id").groupBy("event_type").agg(F.count_if("hit").alias("matches"))


json_query("f_json_exists", "event_type = 'click'", lambda: p.j_exists("json", "list"))
json_query("f_json_contains", "event_type = 'click' AND (k = 2 OR k + 1 = 2)",
           lambda: p.j_contains("json", 2, "list") | p.j_contains("json", 0, "number"))
json_query("f_json_contains_all", "event_type = 'click' AND k = 1", lambda: p.j_contains_all("json", [1, 2], "list"))
json_query("f_json_contains_any", "event_type = 'click' AND (k IN (1, 3) OR k + 1 IN (1, 3))",
           lambda: p.j_contains_any("json", [1, 3], "list"))
json_query("f_json_ne", "event_type = 'click' AND k <> 2", lambda: p.j_ne("json", [2, 3], "list"))


def dynamic_events(spark, sf):
    """Events whose ``props`` are the dynamic part."""
    return table(spark, sf, "events").withColumn(p.META, F.parse_json("props")).drop("props")


@query("f_dynamic_key", J_SQL + "k < 10 AND k IS NOT NULL")
def f_dynamic_key(spark, sf):
    df = dynamic_events(spark, sf)
    return df.where((p.field(df, "k") < 10) & p.has_field(df, "k") & ~p.has_field(df, "missing")).select("event_id")


# ---------------------------------------------------------------- scalar fields

def orders_query(name, sql, predicate):
    @query(name, f"SELECT o_orderkey FROM orders WHERE {sql}")
    def run(spark, sf):
        return table(spark, sf, "orders").where(predicate()).select("o_orderkey")


c = F.col
orders_query("f_compare", "o_totalprice >= 100000 AND o_totalprice < 300000 AND o_orderstatus <> 'P' AND o_custkey > 20",
             lambda: (c("o_totalprice") >= 100000) & (c("o_totalprice") < 300000) & (c("o_orderstatus") != "P") & (c("o_custkey") > 20))
orders_query("f_and_or", "(o_orderstatus = 'F' AND o_totalprice > 250000) OR (o_orderpriority = '5-LOW' AND o_totalprice < 9000)",
             lambda: ((c("o_orderstatus") == "F") & (c("o_totalprice") > 250000)) | ((c("o_orderpriority") == "5-LOW") & (c("o_totalprice") < 9000)))
orders_query("f_in", "o_orderpriority IN ('1-URGENT', '2-HIGH')", lambda: c("o_orderpriority").isin("1-URGENT", "2-HIGH"))
orders_query("f_not_in", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", lambda: ~c("o_orderpriority").isin("1-URGENT", "2-HIGH"))
orders_query("f_like", "o_orderpriority LIKE '4%'", lambda: c("o_orderpriority").like("4%"))


@query("f_mod", "SELECT l_quantity % 7 AS rest, count(*)::bigint AS rows FROM lineitem GROUP BY 1")
def f_mod(spark, sf):
    return table(spark, sf, "lineitem").groupBy((c("l_quantity") % 7).alias("rest")).agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- array fields

TOKENS_SQL = "string_split(lower(text), ' ')"


def tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.split(F.lower("text"), " ", -1).alias("tokens"))


def tokens_query(name, sql, predicate):
    @query(name, f"SELECT doc_id FROM (SELECT doc_id, {TOKENS_SQL} AS a FROM documents) WHERE {sql}")
    def run(spark, sf):
        return tokens(spark, sf).where(predicate()).select("doc_id")


tokens_query("f_array_contains", "list_contains(a, 'the') AND NOT list_contains(a, 'la')",
             lambda: p.a_contains("tokens", "the") & ~p.a_contains("tokens", "la"))
tokens_query("f_array_contains_all", "list_has_all(a, ['the', 'and', 'of'])", lambda: p.a_contains_all("tokens", ["the", "and", "of"]))
tokens_query("f_array_contains_any", "list_has_any(a, ['la', 'le', 'der'])", lambda: p.a_contains_any("tokens", ["la", "le", "der"]))
tokens_query("f_array_length", "len(a) > 100", lambda: p.a_length("tokens") > 100)


@query("f_array_index", "SELECT vec_id FROM embeddings WHERE embedding[1] > 0")
def f_array_index(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.where((p.a_get("embedding", 0) > 0) | (p.a_get("embedding", 64) > 0)).select("vec_id")  # 64 is past the end


@query("f_array_equal", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM'")
def f_array_equal(spark, sf):
    o = table(spark, sf, "orders").withColumn("parts", F.split("o_orderpriority", "-"))
    return o.where(p.a_equal("parts", ["3", "MEDIUM"], "string")).select("o_orderkey")
