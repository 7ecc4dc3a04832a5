"""The operators with production parameters on the whole driver tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm import exact_dedup, fm_index, hard_negatives, line_runs, near_dup, pseudonyms, secret_novelty, sentence_pieces
from vecspark.llm import token_alignment, token_counts, toxicity, url_lists, warc
from vecspark.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401

BLANK_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)"""


@query("op4_exact_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


OP10_SQL = f"""
WITH l AS (SELECT doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents)),
k AS (SELECT doc_id, pos, line, {LOWER_SQL.format(f"trim(line, {BLANK_SQL})")} AS key FROM l),
c AS (SELECT key, count(DISTINCT doc_id) AS n, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key),
m AS (SELECT k.*, coalesce(c.n >= 5 AND k.doc_id <> c.holder, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_runs.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op1_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, "fixed key of the registered query")


# Dated lists and fetch times derived from `pages`: seconds drawn from MD5, within the year from EPOCH_0.
EPOCH_0 = 1_672_531_200  # 2023-01-01
DAY = 86_400
EVENTS = {  # list: (keys, salt, [(action, days after the key's first day)])
    "takedown": ("page", "t", [("block", 0), ("remove", 45), ("block", 120)]),
    "hosts": ("host", "h", [("block", 0), ("allow", 60), ("remove", 140), ("block", 200)]),
    "domains": ("domain", "d", [("block", 0), ("remove", 90)]),
    "partners": ("host", "p", [("allow", 0), ("remove", 100)]),
}


def draw(text, modulus: int):
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long"), F.lit(modulus))


def draw_sql(text: str, modulus: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 7))::bigint % {modulus})"


def list_events(pages: DataFrame) -> DataFrame:
    host = url_lists.host_of(F.col("url"))
    keys = {"page": url_lists.normalised_url(F.col("url")), "host": host, "domain": F.element_at(url_lists.parent_domains(host), 1)}
    out = None
    for name, (kind, salt, steps) in EVENTS.items():
        own = pages.select(keys[kind].alias("key")).filter("key <> ''").distinct()
        first = draw(F.concat("key", F.lit(salt)), 365 * DAY) - 100 * DAY + EPOCH_0
        rows = own.select(F.lit(name).alias("list"), "key", first.alias("s"), F.explode(F.array(
            *[F.struct(F.lit(a).alias("action"), F.lit(d * DAY).alias("after")) for a, d in steps])).alias("e"))
        rows = rows.select("list", "key", F.col("e.action").alias("action"), F.timestamp_seconds(F.col("s") + F.col("e.after")).alias("at"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _events_sql() -> str:
    parts = []
    for name, (kind, salt, steps) in EVENTS.items():
        for i, (action, days) in enumerate(steps):
            if action == "remove":
                continue
            until = f"{steps[i + 1][1] * DAY}" if i + 1 < len(steps) else "NULL"
            first = f"{draw_sql(f"{kind} || '{salt}'", 365 * DAY)} - {100 * DAY} + {EPOCH_0}"
            parts.append(f"SELECT DISTINCT '{name}' AS list, {kind} AS key, '{action}' AS action, {first} + {days * DAY} AS since, "
                         f"{first} + {until} AS until FROM p WHERE {kind} <> ''")
    return " UNION ALL ".join(parts)


OP6_SQL = rf"""
WITH raw AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
h AS (SELECT page_id, {draw_sql("page_id::varchar || 'f'", 365 * DAY)} + {EPOCH_0} AS t,
        regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host,
        rtrim(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS path FROM raw),
p AS (SELECT *, host || path AS page, array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM h),
e AS ({_events_sql()}),
k AS (SELECT DISTINCT page_id, t, unnest(list_concat([page], [host], list_transform(range(2, len(string_split(host, '.')) + 1),
        lambda n: array_to_string(string_split(host, '.')[-n:], '.')))) AS key FROM p WHERE host <> ''),
m AS (SELECT page_id, key, action, list, length(key) AS n FROM k JOIN e USING (key) WHERE t >= since AND (until IS NULL OR t < until)),
b AS (SELECT page_id, count(*) AS n_active, max({{'n': n, 'block': action = 'block', 'key': key, 'list': list}}) AS best FROM m GROUP BY page_id)
SELECT page_id, CASE WHEN best.block THEN 'block' ELSE 'allow' END AS verdict, best.key AS deciding_key,
       best.list AS deciding_list, coalesce(n_active, 0) AS n_active FROM p LEFT JOIN b USING (page_id)"""


@query("op6_url_lists", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    fetched = F.timestamp_seconds(draw(F.concat(F.col("page_id").cast("string"), F.lit("f")), 365 * DAY) + EPOCH_0)
    return url_lists.judge(pages.select("page_id", "url", fetched.alias("fetched_at")), list_events(pages))


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
d AS (SELECT page_id, octet_length(encode(b))::bigint AS payload_bytes, sha1(b) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN coalesce(page_id <> last, false) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)"""


@query("op9_warc", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_WORDS = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {OP8_WORDS.format(LOWER_SQL.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT item_id, {OP8_WORDS.format(LOWER_SQL.format("coalesce(text, '')"))} AS w FROM benchmark),
n AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS k
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM n) WHERE len(w) >= k)),
m AS (SELECT o.doc_id, o.i, o.k, n.item_id FROM o JOIN n USING (g, k)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::varchar, ',' ORDER BY item_id::varchar) AS s
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


@query("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_sentence_pieces")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentence_pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def held_out(doc_id):
    """Rows that labels are never learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels.filter(~F.coalesce(held_out("doc_id"), F.lit(True))))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs.select("doc_id", "text"), toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op5_near_dup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.find_near_copies(table(spark, sf_dir, "documents"))


@query("op11_secret_novelty")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_novelty.find_secrets(docs, secret_novelty.identifier_dictionary(docs))
    base = secret_novelty.span_text(F.filter("spans", lambda s: s["novelty"].isNull()))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"),
                        secret_novelty.span_text(F.col("spans")).alias("spans"), "n_novel")


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.e, r.e)::bigint AS score
      FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::int AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)
