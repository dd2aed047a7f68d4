"""One query per operator, over its whole tables, and the SQL it is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableaudit.llm import (
    decontam, exactdedup, importance, infill, langid, licenses, linededup, mixing, neardedup, pii, sharding, tokens,
    toxicity,
)
from tableaudit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = rf"regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+')"


@_query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@_query(
    "op2_source_mix",
    rf"""
    WITH rows AS (
        SELECT doc_id, coalesce('0' || source, '1') AS source, coalesce(doc_id::VARCHAR, '') AS key,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
        FROM documents),
    sizes AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source) - 1) % 3 + 1]::DOUBLE AS weight
        FROM rows GROUP BY source),
    live AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM sizes WHERE source_size > 0),
    levels AS (
        SELECT ratio, source,
               ((SELECT sum(source_size) FROM live)::DOUBLE
                - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY ratio, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM live),
    targets AS (
        SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE
            least(weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source LIMIT 1), 3.0::DOUBLE * source_size) END AS target,
            greatest(ceil(source_size / {mixing.BLOCK_WORDS}.0), 1)::BIGINT AS n_blocks
        FROM sizes),
    plan AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets),
    dealt AS (
        SELECT r.*, source_size, target, whole, target - whole * source_size AS rest,
               floor((h >> 30) * n_blocks / 1073741824.0)::BIGINT AS block
        FROM rows r JOIN plan USING (source)),
    runs AS (
        SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY block, h, key, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM dealt)
    SELECT doc_id, size, source_size, round(target, 6) AS target,
           (size * CASE WHEN size = 0 THEN 0 ELSE
               whole + CASE WHEN rest > 0 AND start + size / 2.0 <= rest THEN 1 ELSE 0 END END)::BIGINT AS taken
    FROM runs
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_digest(docs)


@_query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.personal_data(table(spark, sf_dir, "documents")))


@_query("op4_line_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digest(linededup.dedup_lines(table(spark, sf_dir, "documents")))


@_query(
    "op5_near_duplicates",
    rf"""
    WITH RECURSIVE words AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
    sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM words),
    each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN least USING (doc_id)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query(
    "op6_exact_duplicates",
    f"""
    WITH rows AS (SELECT doc_id, {_FOLD} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM rows
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


@_query("op7_languages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@_query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digest(table(spark, sf_dir, "documents"), tokenizer_path())


@_query(
    "op9_contamination",
    rf"""
    WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    items AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n,
               unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
                      lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS x
        FROM items WHERE len(w) > 0),
    spans AS (
        SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2),
               lambda i: {{'place': i, 'x': array_to_string(w[i:i + n - 1], ' ')}})) AS s
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
    found AS (SELECT doc_id, s.place AS place, spans.n, item_id FROM spans JOIN windows ON s.x = windows.x AND spans.n = windows.n),
    hit AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(place, place + n)) AS p FROM found) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.item_digest(decontam.decontaminate(docs, benchmark))


@_query(
    "op10_hash_shards",
    f"""
    WITH rows AS (
        SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
               lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || coalesce('|' || text, '')), 1, 15))::BIGINT),
                    60, '0') AS bits
        FROM documents),
    nodes AS (
        SELECT depth, left(bits, depth) AS prefix, sum(bytes) AS held, count(*) AS n
        FROM rows, (SELECT unnest(range(0, 31)) AS depth) GROUP BY ALL),
    fits AS (
        SELECT doc_id, bytes, min_by(prefix, depth) AS shard
        FROM rows JOIN nodes ON left(bits, depth) = prefix AND (held <= {sharding.LIMIT_BYTES} OR n = 1)
        GROUP BY doc_id, bytes)
    SELECT doc_id, bytes, shard FROM fits
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "bytes", "shard")


_SHA = f"sha256('{infill.SEED}:' || coalesce(doc_id::VARCHAR, ''))"
_DRAWS = ", ".join(f"('0x' || substr({_SHA}, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))


@_query(
    "op11_fill_in_middle",
    rf"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS u, {_DRAWS}
        FROM documents),
    cuts AS (
        SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low,
               greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                         OR h3 % 100 >= {infill.CHANGED_PERCENT} THEN 'plain'
                    WHEN h4 % 100 < {infill.SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form
        FROM units),
    parts AS (
        SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m,
               array_to_string(u[high + 1:], '') AS s
        FROM cuts)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digest(infill.fill_in_middle(table(spark, sf_dir, "documents")))


@_query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op13_importance")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = importance.resample(docs, target)
    return found.select("doc_id", "n_features", "weight", "score", "rank")
