"""The corpus operators as queries over the given tables, with their DuckDB equivalents."""

from pyspark.sql import functions as F

from . import (
    exact_dedup,
    filter_audit,
    hard_negatives,
    lang_id,
    multi_index,
    pfair,
    piece_viterbi,
    secret_scan,
    simhash_dedup,
    token_shards,
    toxicity,
    url_filter,
    warc_fixity,
)


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    groups = exact_dedup.copy_groups(_read(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def op2_simhash_dedup(spark, sf_dir):
    groups = simhash_dedup.near_groups(_read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id", "group_size")


def op3_lang_id(spark, sf_dir):
    return lang_id.identify(_read(spark, sf_dir, "documents"))


def op4_multi_index(spark, sf_dir):
    return multi_index.neighbours(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_token_shards(spark, sf_dir):
    import public_tokenizers

    found = token_shards.round_trip(
        _read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_warc_fixity(spark, sf_dir):
    damaged = F.col("page_id") % 101 == 7
    found = warc_fixity.audit_pages(_read(spark, sf_dir, "pages"), damaged)
    return found.select(
        "page_id", F.col("length").alias("n_bytes"),
        F.lower(F.hex("digest")).alias("record_sha256"), "corrupt",
    )


def op7_secret_scan(spark, sf_dir):
    return secret_scan.digests(secret_scan.scan(_read(spark, sf_dir, "documents")))


def op8_pfair_mix(spark, sf_dir):
    return pfair.mix(_read(spark, sf_dir, "documents"))


def op9_sentencepiece(spark, sf_dir):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_viterbi.round_trip(_read(spark, sf_dir, "documents"), model)
    return coded.select(
        "doc_id", "n_pieces", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
        F.length("decoded").cast("long").alias("n_chars"),
    )


def op10_toxicity(spark, sf_dir):
    return toxicity.scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op12_url_filter(spark, sf_dir):
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _matches_sql(number, pattern, group, least):
    """Matches of a kind in DuckDB: places are the lengths of what comes before them."""
    pattern = pattern.replace("'", "''")
    return f"""
        SELECT rn, doc_id, source, {number} AS kind, g[i] AS value, length(m[i]) AS size,
               CAST(coalesce(list_sum(list_transform(s[1:i], lambda x: length(x))), 0)
                    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
        FROM (SELECT rn, doc_id, source, m, s, g, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT rn, doc_id, source, regexp_extract_all(t, '{pattern}', 0) AS m,
                           regexp_split_to_array(t, '{pattern}') AS s,
                           regexp_extract_all(t, '{pattern}', {group}) AS g FROM d))
        WHERE length(g[i]) >= {least}"""


_SECRETS_SQL = "WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS t FROM documents),\n" + f"""
    base AS ({" UNION ALL ".join(
        _matches_sql(i, p, g, n) for i, (_, p, g, n, _) in enumerate(secret_scan.BASE_KINDS)
    )}),
    opaque AS (
        SELECT * FROM ({_matches_sql(3, "[A-Za-z0-9+/_=-]+", 0, 20)}) o
        WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
          AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rn = o.rn AND b.a < o.a + o.size
                                                 AND o.a < b.a + b.size)),
    found AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
    owners AS (
        SELECT value, count(DISTINCT coalesce('=' || source, '')) < {secret_scan.EXAMPLE_OWNERS}
               AND count(DISTINCT coalesce('=' || doc_id, '')) < {secret_scan.EXAMPLE_REPOS} AS live
        FROM found GROUP BY value),
    shown AS (
        SELECT rn, kind, a, live,
               (['assign', 'access', 'hex', 'opaque'])[kind + 1] || ':' || a || ':' || (a + size) AS span
        FROM found JOIN owners USING (value) WHERE kind < 3 OR live)
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign,
           count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
           sha256(coalesce(string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE kind < 3), ''))
               AS base_sha256,
           coalesce(string_agg(span, ',' ORDER BY a, kind), '') AS spans,
           count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example
    FROM d LEFT JOIN shown USING (rn) GROUP BY rn, doc_id
"""

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_lang_id": op3_lang_id,
    "op4_multi_index": op4_multi_index,
    "op5_token_shards": op5_token_shards,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_secret_scan": op7_secret_scan,
    "op8_pfair_mix": op8_pfair_mix,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_url_filter": op12_url_filter,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1
                   AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_warc_fixity": r"""
        WITH page AS (
            SELECT page_id, coalesce(html, '') AS body,
                   regexp_replace(coalesce(url, ''), '[\r\n]', ' ', 'g') AS target
            FROM pages
        ), named AS (
            SELECT *, sha256(body) AS digest,
                   md5(concat_ws('|', page_id::VARCHAR, target, sha256(body))) AS k
            FROM page
        ), record AS (
            SELECT page_id, body, concat_ws(chr(13) || chr(10),
                'WARC/1.0', 'WARC-Type: resource', 'WARC-Target-URI: ' || target,
                'WARC-Date: 2024-01-01T00:00:00Z',
                'WARC-Record-ID: <urn:uuid:' || concat_ws('-', substr(k, 1, 8), substr(k, 9, 4),
                    substr(k, 13, 4), substr(k, 17, 4), substr(k, 21, 12)) || '>',
                'WARC-Page-Id: ' || page_id::VARCHAR, 'WARC-Payload-Digest: sha256:' || digest,
                'Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(body)::VARCHAR,
                '', body) AS text
            FROM named
        )
        SELECT page_id, strlen(text)::BIGINT AS n_bytes, sha256(text) AS record_sha256,
               coalesce(page_id % 101 = 7 AND body <> '', false) AS corrupt
        FROM record
    """,
    "op7_secret_scan": _SECRETS_SQL,
    "op11_filter_audit": r"""
        WITH split AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') AS w
            FROM documents
        ), label AS (
            SELECT doc_id, max(quality) FILTER (WHERE quality = 1) AS good,
                   max(toxic) FILTER (WHERE toxic = 1) AS bad
            FROM labels GROUP BY doc_id
        ), doc AS (
            SELECT part, coalesce(good = 1, false) AS good, coalesce(bad = 1, false) AS bad,
                   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                    regexp_matches(t, '[#$%&*|]'),
                    coalesce(split.doc_id > min(split.doc_id) OVER (PARTITION BY t), false)] AS f
            FROM split LEFT JOIN label USING (doc_id)
        ), sets AS (
            SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
            FROM doc GROUP BY part, f
        ), letters AS (SELECT unnest(range(1, 6)) AS i
        ), orders AS (
            SELECT [a.i, b.i, c.i, d.i, 15 - a.i - b.i - c.i - d.i] AS o
            FROM letters a, letters b, letters c, letters d
            WHERE len(list_distinct([a.i, b.i, c.i, d.i])) = 4
        ), steps AS (
            SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', CAST(x AS INTEGER), 1)), '') AS filter_order,
                   CAST(s.i AS INTEGER) AS step, o[s.i] AS own, o[1:s.i - 1] AS prior
            FROM orders, letters s
        ), each AS (
            SELECT part, filter_order, step, own, n, good, bad, f[own] AS has,
                   list_bool_or(list_transform(prior, lambda x: f[x]) || [false]) AS gone,
                   len(list_filter(f, lambda x: x)) AS fails
            FROM sets, steps
        ), out AS (
            SELECT part, filter_order, step, own,
                   sum(n) FILTER (WHERE NOT has AND NOT gone) AS kept,
                   sum(n) FILTER (WHERE has AND NOT gone) AS removed,
                   sum(n) FILTER (WHERE has AND gone) AS redundant,
                   sum(n) FILTER (WHERE has AND fails = 1) AS unique_fails,
                   sum(good) FILTER (WHERE has AND NOT gone) AS good_lost,
                   sum(bad) FILTER (WHERE has AND NOT gone) AS toxic_lost
            FROM each GROUP BY ALL
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
               coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
               coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
        FROM out
    """,
    "op13_hard_negatives": """
        WITH e AS (
            SELECT row_number() OVER () AS rn, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.rn AS arn, a.vec_id AS anchor_id, e.rn, e.vec_id, e.label = a.label AS same,
                   CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
            FROM e a JOIN e ON a.rn <> e.rn WHERE a.vec_id % 100 = 0
        ), positive AS (
            SELECT arn, anchor_id, rn, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY arn ORDER BY score DESC, vec_id NULLS LAST, rn) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
               s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM positive p JOIN scored s
          ON p.arn = s.arn AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
        WINDOW w AS (PARTITION BY p.arn, p.rn ORDER BY s.score DESC, s.vec_id NULLS LAST, s.rn)
        QUALIFY row_number() OVER w <= 5
    """,
}
