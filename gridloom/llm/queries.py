"""The subpackage's queries: ``opN_<name>`` over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

REQUIRED_TEXT = "\\### Assistant: </turn> ok"


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import warc_transactions

    return warc_transactions(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path() -> str:
    """The public byte-level vocabulary; the same path on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op8_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import chat_digest

    turn = F.col("id")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit(REQUIRED_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_digest(rows).drop("layout")


def op2_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text", "source_hash")


def op4_context_mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


def op5_url_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' captures against a list history. The tables hold neither, so
    both follow from hashes: each host, registered domain and some first path
    parts get dated events, each page a fetch day in 2024."""
    from .url_filters import evaluate, host_of, path_parts

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = lambda c: F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 4), 16, 10).cast("int")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", day(number(F.col("page_id")) % 366).alias("day"))
    host, part = host_of(F.col("url")), F.get(path_parts(F.col("url")), F.lit(0))
    keys = F.array_compact(F.array(host, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.concat(host, F.lit("/"), part)))
    known = pages.select(F.explode(keys).alias("key")).where("key <> ''").distinct().withColumn("x", number(F.col("key"))).where("x % 3 <> 2 or key not like '%/%'")
    lists = F.element_at(F.array(*[F.lit(n) for n in ("ads", "malware", "adult", "allow")]), F.col("x") % 4 + 1)
    x = F.col("x")
    one = lambda when, n, action: F.when(when, F.struct(day(n).alias("day"), F.lit(action).alias("action")))
    dated = F.array_compact(F.array(one(F.lit(True), x % 300, "add"), one(x % 3 != 0, x % 300 + 30 + x % 60, "remove"), one(x % 5 == 0, x % 300 + 60 + x % 90, "add")))
    events = known.select("key", lists.alias("list"), F.explode(dated).alias("e")).select("key", "list", "e.day", "e.action")
    return evaluate(captures, events).withColumnRenamed("capture_id", "page_id").withColumn("day", F.col("day").cast("string"))


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"))


def op10_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_transactions,
        op2_difference_cover_dedup,
        op3_wu_manber_decontamination,
        op4_context_mixing_scores,
        op5_url_history,
        op6_simhash_components,
        op7_weak_toxicity,
        op8_genetic_packing,
        op9_chat_format,
        op10_graph_neighbours,
    )
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_warc_transactions"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS h, payload,
         min(page_id) OVER (PARTITION BY payload) AS first_id
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 5 * CAST(i // 4 AS INTEGER) + 1, 5) AS INTEGER) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

ORACLE_SQL["op3_wu_manber_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bwin AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), hits AS (
  SELECT dwin.doc_id, dwin.i, dwin.n, bwin.item_id FROM dwin JOIN bwin USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op9_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\<#]', '', 'g')) AS escaped FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + 14) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE_SQL["op2_difference_cover_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), held AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first_id FROM win
), gone AS (
  SELECT doc_id, list(DISTINCT k) AS ks
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM held WHERE first_id < doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ks IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ks, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

ORACLE_SQL["op5_url_history"] = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda s: s <> '') AS parts,
         DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 4))::INTEGER % 366 AS INTEGER) AS day
  FROM pages
), k AS (
  SELECT DISTINCT key FROM (
    SELECT host AS key FROM p UNION ALL SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM p
    UNION ALL SELECT host || '/' || parts[1] FROM p WHERE len(parts) > 0) WHERE key <> ''
), kx AS (
  SELECT key, ('0x' || substr(md5(key), 1, 4))::INTEGER AS x FROM k
), e AS (
  SELECT key, ['ads', 'malware', 'adult', 'allow'][x % 4 + 1] AS list, unnest([
    {'day': DATE '2024-01-01' + x % 300, 'on': true, 'live': true},
    {'day': DATE '2024-01-01' + (x % 300 + 30 + x % 60), 'on': false, 'live': x % 3 <> 0},
    {'day': DATE '2024-01-01' + (x % 300 + 60 + x % 90), 'on': true, 'live': x % 5 = 0}]) AS v
  FROM kx WHERE x % 3 <> 2 OR NOT contains(key, '/')
), ev AS (
  SELECT key, list, v.day AS day, bool_or(v.on) AS live FROM e WHERE v.live GROUP BY ALL
), keys AS (
  SELECT DISTINCT page_id, day, key FROM (
    SELECT page_id, day, host AS key FROM p
    UNION ALL SELECT page_id, day, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
      FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM p)
    UNION ALL SELECT page_id, day, host || '/' || parts[1] FROM p WHERE len(parts) > 0)
), state AS (
  SELECT page_id, keys.day, keys.key, list, arg_max(live, ev.day) AS live
  FROM keys JOIN ev ON ev.key = keys.key AND ev.day <= keys.day GROUP BY ALL
), hit AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, bool_or(list = 'allow') AS allowed
  FROM state WHERE live GROUP BY page_id
)
SELECT p.page_id, CAST(p.day AS VARCHAR) AS day, CAST(coalesce(n, 0) AS BIGINT) AS n_active, coalesce(lists, '') AS lists,
       coalesce(n > 0 AND NOT allowed, false) AS blocked
FROM p LEFT JOIN hit USING (page_id)
"""
