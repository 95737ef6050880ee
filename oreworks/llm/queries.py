"""One registered query per operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.llm import (
    bpe,
    divergence,
    fmindex,
    hosts,
    passages,
    resampling,
    roles,
    secretscan,
    shards,
    simhash,
    toxicity,
    vectors,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    "op1_warc_archive",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS body FROM pages
    ), d AS (
        SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex,
               max(page_id) OVER (PARTITION BY body) AS owner
        FROM p
    )
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
           array_to_string([
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(hex, (i // 4)::INT * 5 + 1, 5))::BIGINT >> (5 * (3 - i % 4))::INT) & 31)::INT + 1, 1)
               FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM owner THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to
    FROM d
    """,
)
def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A content-addressed archive of all pages, read back."""
    read = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return read.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_WORDS = r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@_query(
    "op2_fm_index",
    f"""
    WITH b AS (
        SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, least(10, len(w)) AS n,
               array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS part
        FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0
    ), d AS (
        SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
    ), places AS (
        SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS part
        FROM d, (SELECT DISTINCT n FROM windows) l, unnest(range(1, len(w) - n + 2)) t(i)
    ), hits AS (
        SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, part)
    ), words AS (
        SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) t(j) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows cover."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fmindex.find_benchmark(documents, _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )


@_query("op3_role_repair")
def op3_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn after the cheapest repair of its conversation, and what it renders to."""
    found = roles.repair_roles(_table(spark, sf_dir, "conversations"))
    return found.select(
        F.col("conv").alias("conv_id"), "nth", "turn", "action", "new_role",
        F.array_join("inserted_before", ",").alias("inserted_before"),
        F.array_join("inserted_after", ",").alias("inserted_after"), "cost", "piece",
    )


@_query("op4_host_segmentation")
def op4_host_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    found = hosts.judged(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score")


@_query("op5_simhash_pigeonring")
def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies of every document."""
    found = simhash.near_copies(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_digits().alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@_query("op6_compact_windows")
def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has alike."""
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"),
        "start",
        "end",
        F.col("source").alias("source_id"),
        "source_start",
        "source_end",
        F.round("similarity", 6).alias("similarity"),
    )


@_query("op7_prefix_trie_bpe")
def op7_prefix_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the text they decode to."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode_digests(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


@_query("op8_compression_distance")
def op8_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the rows is held out from fitting."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", toxicity.rejected().cast("int").alias("predicted")
    )


@_query("op9_kmeans_near_copies")
def op9_kmeans_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, group and representative of every vector."""
    found = vectors.linked_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept"
    )


@_query("op10_two_pass_shuffle")
def op10_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, row counts at most one apart."""
    placed = shards.shuffle_into_shards(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# What stands between a word of the assign rule and its value, and the forms of the kinds in SQL's regular expressions.
_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    """|[aA][pP][iI]_?[kK][eE][yY])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_KINDS = {
    "assign": _ASSIGN,
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{16,}",
    "pem": "-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "hub": "gh[opsur]_[A-Za-z0-9]{36,}",
    "chat": "xox[abprs]-[A-Za-z0-9-]{10,}",
}


def _matches_sql(place: int, kind: str, pattern: str) -> str:
    """Matches of a kind; each starts after the gaps and the matches before it."""
    tested = {"assign": "length(v[i]) >= 12", "access": "length(m[i]) >= 18"}.get(kind, "true")
    value = f"regexp_extract_all(body, '{pattern}', 2)" if kind == "assign" else "m"
    return f"""
    SELECT doc_id, {place} AS place, '{kind}' AS kind, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i:
        CASE WHEN {tested} THEN {{
            'a': (list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::BIGINT,
            'n': length(m[i])}} END), lambda x: x IS NOT NULL)) AS s
    FROM (SELECT doc_id, m, {value} AS v, string_split_regex(body, '{pattern}') AS g
          FROM (SELECT doc_id, body, regexp_extract_all(body, '{pattern}') AS m FROM d) WHERE len(m) > 0)"""


@_query(
    "op11_trigram_secrets",
    f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS body FROM documents
    ), found AS ({' UNION ALL '.join(_matches_sql(i, *x) for i, x in enumerate(_KINDS.items()))}
    ), listed AS (
        SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
               count(*) FILTER (place = 2) AS n_hex,
               string_agg(kind || ':' || s.a || ':' || (s.a + s.n), ',' ORDER BY s.a, place) FILTER (place < 3) AS base,
               string_agg(kind || ':' || s.a || ':' || (s.a + s.n), ',' ORDER BY s.a, place) AS spans
        FROM found GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
           coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN listed USING (doc_id)
    """,
)
def op11_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by all rules."""
    found = secretscan.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secretscan.BASE_RULES]

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *map(count, base),
        F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


# CRC-32 of a text: one step per byte, with the table that its polynomial gives.
_CRC_TABLE = "range(256)"
for _ in range(8):
    _CRC_TABLE = f"list_transform({_CRC_TABLE}, lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_BYTES = "list_transform(range(strlen(part)), lambda i: ('0x' || hex(encode(part))[2 * i + 1:2 * i + 2])::BIGINT)"
_CRC = f"""xor(4294967295, list_reduce({_BYTES},
    lambda crc, byte: xor(crc >> 8, steps[(xor(crc, byte) & 255) + 1]), 4294967295::BIGINT))"""


def _features_sql(table: str, row: str) -> str:
    """Runs of one to three words of every text."""
    return f"""
    SELECT {row}, array_to_string(w[i:i + n - 1], ' ') AS part
    FROM (SELECT {row}, coalesce({_WORDS}, []) AS w FROM {table}), unnest(range(1, 4)) l(n), unnest(range(1, len(w) - n + 2)) t(i)"""


@_query(
    "op12_importance_resampling",
    f"""
    WITH d AS (
        SELECT *, row_number() OVER () AS r FROM documents
    ), f AS ({_features_sql("d", "r")}
    ), g AS ({_features_sql("benchmark", "item_id")}
    ), hashed AS (
        SELECT part, {_CRC} % 10000 AS bucket
        FROM (SELECT part FROM f UNION SELECT part FROM g), (SELECT {_CRC_TABLE} AS steps)
    ), s AS (
        SELECT bucket, count(*) AS n FROM f JOIN hashed USING (part) GROUP BY 1
    ), t AS (
        SELECT bucket, count(*) AS n FROM g JOIN hashed USING (part) GROUP BY 1
    ), gains AS (
        SELECT bucket, floor(1000 * ln(
            (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
            / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
    ), weights AS (
        SELECT r, count(*) AS n, sum(gain) AS weight FROM f JOIN hashed USING (part) JOIN gains USING (bucket) GROUP BY 1
    ), scores AS (
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
               (coalesce(weight, 0) + floor(-1000 * ln(-ln(
                   (('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score,
               len(coalesce({_WORDS}, [])) >= 20 AS able
        FROM d LEFT JOIN weights USING (r)
    )
    SELECT doc_id, n_features, weight, score,
           CASE WHEN able AND nth <= 5 * (SELECT count(*) FROM scores WHERE able) // 100 THEN nth END AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS nth FROM scores)
    """,
)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark texts."""
    found = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@_query(
    "op13_source_divergence",
    r"""
    WITH t AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), tokens AS (
        SELECT r, lang, source, unnest(terms) AS term FROM t
    ), kept AS (
        SELECT lang, term, count(*)::HUGEINT AS n FROM tokens GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10
    ), langs AS (
        SELECT lang, sum(n) AS n, count(*)::HUGEINT AS v FROM kept GROUP BY 1
    ), counts AS (
        SELECT lang, source, term, count(*)::HUGEINT AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3
    ), groups AS (
        SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n
        FROM (SELECT DISTINCT lang, source FROM t) g LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source
        GROUP BY 1, 2
    ), p AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.n + 2 * l.v) AS p,
               1 + 1000000000::HUGEINT * (k.n + 2) // (l.n + 2 * l.v) AS q
        FROM groups g JOIN langs l ON g.lang = l.lang JOIN kept k ON k.lang = g.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), sums AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
    ), pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    ), tops AS (
        SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
        FROM p WHERE n > 0 AND p > q
    )
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM tops))
    WHERE part = 'pair' OR rank <= 10
    """,
)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most telling terms."""
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))
