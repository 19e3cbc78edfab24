"""The registered queries of this folder and their SQL twins, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, language, mixing, near_dedup, packing, phrases, ppm, prefix_trie, sketches, snapshots, toxicity, url_rules
from .common import prepared, remainder, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = remainder("doc_id", 4) == 2
    model = language.learn(docs.where(~out))
    named = language.identify(docs.select("doc_id", "text", out.alias("held_out")), model)
    return named.select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_coverage").alias("coverage")
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return ppm.score(table(spark, sf_dir, "documents"), remainder("doc_id", 10) == 0)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return bpe.digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remainder("doc_id", 3) == 1
    model = toxicity.learn(docs.where(~out), table(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted", "spans")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return near_dedup.decide(table(spark, sf_dir, "documents"))


RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    listed = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {listed} AS r(host, path, verdict)")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op8_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return snapshots.render(table(spark, sf_dir, "conversations"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return sketches.compare(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return phrases.collocations(*phrases.mine(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (op1_language_id, op2_lm_score, op3_byte_bpe, op4_toxicity, op5_exact_dedup, op6_near_dedup, op7_url_rules, op8_chat_snapshots, op9_fingerprints, op10_source_mix, op11_packing, op12_collocations, op13_prefix_trie)
}

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)

ORACLES = {
    "op5_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM n WINDOW w AS (PARTITION BY text_sha256)""",
    "op6_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE [array_to_string(words[i : i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common >= 85 * (x.n + y.n - common)),
        r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id, d.doc_id = min(reached) AS kept
        FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op7_url_rules": rf"""
        WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
        p AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        m AS (
            SELECT DISTINCT host, path, rule_host || rule_path AS rule, verdict,
                   row_number() OVER (PARTITION BY host, path
                                      ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
            FROM (SELECT DISTINCT host, path FROM p) q
            JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
        FROM p LEFT JOIN m ON m.host = p.host AND m.path = p.path AND m.place = 1""",
    "op8_chat_snapshots": r"""
        WITH t AS (
            SELECT DISTINCT conv_id, 0 AS alone, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
            UNION ALL SELECT NULL, row_number() OVER (), turn, role, text FROM conversations WHERE conv_id IS NULL),
        c AS (
            SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS said
            FROM t GROUP BY conv_id, alone),
        kept AS (
            SELECT min(conv_id) AS conv_id, count(*) AS copies, said FROM c
            WHERE NOT EXISTS (SELECT 1 FROM c AS d WHERE d.said[1] = c.said[1] AND len(d.said) > len(c.said)
                              AND d.said[1:len(c.said)] = c.said)
            GROUP BY said)
        -- Parts of a thousand turns.
        SELECT conv_id, part, len(said) AS n_turns, copies,
               list_aggregate(list_transform(said[part * 1000 + 1 : part * 1000 + 1000], lambda s: '<|im_start|>'
                   || replace(replace(coalesce(s.role, 'unknown'), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')
                   || chr(10)
                   || replace(replace(coalesce(s.text, ''), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')
                   || '<|im_end|>' || chr(10)), 'string_agg', '') AS chat
        FROM kept, LATERAL (SELECT unnest(range(0, (len(said) + 999) // 1000)) AS part)""",
    "op10_source_mix": rf"""
        WITH d AS (
            SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   ('0x' || substr(md5('17/' || doc_id), 1, 8))::BIGINT AS draw
            FROM documents),
        s AS (
            SELECT key, any_value(source) AS source, sum(size)::BIGINT AS source_size,
                   row_number() OVER (ORDER BY any_value(source) NULLS LAST) AS place
            FROM d GROUP BY key),
        w AS (SELECT *, [3.0, 1.0, 2.0][(place - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM s),
        l AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (
                        ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM w),
        t AS (
            SELECT key, source_size, place,
                   least(most, coalesce(max(CASE WHEN level * weight <= most THEN level END) OVER () * weight, most)) AS target,
                   greatest(1, ceil(source_size / {mixing.SHARD}.0))::BIGINT AS shards
            FROM l),
        -- Highest quotients, written out: every quotient that can win is listed and ranked.
        q AS (
            SELECT key, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS place,
                   floor(sum(target) OVER (PARTITION BY k) / {mixing.BLOCK} + 0.5) AS seats, k
            FROM t, LATERAL (SELECT unnest(range(0, (source_size * 2 // {mixing.BLOCK} + 100)::BIGINT)) AS k) WHERE target > 0),
        ss AS (
            SELECT key, count(*) AS source_seats FROM q
            WHERE place <= (SELECT floor(sum(target) / {mixing.BLOCK} + 0.5) FROM t) GROUP BY key),
        e AS (SELECT d.*, source_size, target, shards, draw % shards AS shard, coalesce(source_seats, 0) AS source_seats
              FROM d JOIN t USING (key) LEFT JOIN ss USING (key)),
        c AS (SELECT key, shard, source_seats, sum(size)::BIGINT AS words FROM e GROUP BY ALL),
        cq AS (
            SELECT key, shard, source_seats,
                   row_number() OVER (PARTITION BY key ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard, k) AS place
            FROM c, LATERAL (SELECT unnest(range(0, (words * 2 // {mixing.BLOCK} + 100)::BIGINT)) AS k) WHERE words > 0),
        cs AS (SELECT key, shard, count(*) AS quota FROM cq WHERE place <= source_seats GROUP BY key, shard),
        b AS (
            SELECT c.key, c.shard, words, coalesce(quota, 0) AS quota, ceil(words / {mixing.BLOCK}.0)::BIGINT AS blocks,
                   ('0x' || substr(md5('17/order/' || c.key || '/' || c.shard), 1, 8))::BIGINT AS turn
            FROM c LEFT JOIN cs ON cs.key = c.key AND cs.shard = c.shard),
        f AS (
            SELECT *, least(quota // greatest(blocks, 1), 2) AS each,
                   CASE WHEN quota >= 2 * blocks THEN 0 ELSE quota % greatest(blocks, 1) END AS more,
                   [1000000007, 1000000009, 1000000021, 1000000033][turn % 4 + 1] AS step
            FROM b),
        p AS (
            SELECT *, sum(size) OVER (PARTITION BY key, shard ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
            FROM e),
        g AS (
            SELECT p.doc_id,
                   sum((least((b + 1) * {mixing.BLOCK}, stop) - greatest(b * {mixing.BLOCK}, stop - size))
                       * (each + CASE WHEN (b * (step % blocks) + turn) % blocks < more THEN 1 ELSE 0 END))::BIGINT AS taken
            FROM p JOIN f ON f.key = p.key AND f.shard = p.shard,
                 LATERAL (SELECT unnest(range((stop - size) // {mixing.BLOCK}, (stop - 1) // {mixing.BLOCK} + 1)) AS b)
            WHERE size > 0 GROUP BY p.doc_id)
        SELECT p.doc_id, size::BIGINT AS size, source_size, target, coalesce(taken, 0) AS taken
        FROM p LEFT JOIN g ON g.doc_id = p.doc_id""",
    "op12_collocations": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        g AS (
            SELECT lang, 1 AS words, unnest(words) AS phrase FROM w
            UNION ALL SELECT lang, 2, unnest([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) FROM w
            UNION ALL SELECT lang, 3, unnest([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)]) FROM w),
        f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
        c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS parts FROM f WHERE words > 1 AND f >= 10),
        cuts AS (
            SELECT lang, phrase, a, k, array_to_string(parts[1:k], ' ') AS first, array_to_string(parts[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, words)) AS k FROM c)),
        s AS (
            SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = first JOIN f r ON r.lang = cuts.lang AND r.phrase = rest
            QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
        kept AS (
            SELECT * FROM s WHERE NOT EXISTS (
                SELECT 1 FROM c WHERE c.words = 3 AND c.lang = s.lang AND 100 * c.a >= 50 * s.a
                    AND (c.parts[1] || ' ' || c.parts[2] = s.phrase OR c.parts[2] || ' ' || c.parts[3] = s.phrase)))
        SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000""",
    "op13_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT c, list(struct_pack(role := role, text := text) ORDER BY p) AS turns FROM t GROUP BY c),
        -- crc32, bit by bit
        bits AS (
            SELECT c, list_reduce([4294967295::BIGINT] || list_transform(range(len(c::VARCHAR) * 9), lambda i: i), lambda crc, i:
                CASE WHEN i % 9 = 0 THEN xor(crc, ascii(substr(c::VARCHAR, (i // 9 + 1)::BIGINT, 1))::BIGINT)
                     WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384::BIGINT) ELSE crc // 2 END) AS crc
            FROM own),
        h AS (SELECT c, xor(crc, 4294967295::BIGINT) % 6 AS h, c - c % 100 AS base FROM bits),
        r AS (
            SELECT own.c, coalesce(b.turns[1:h.h], []) || coalesce(own.turns[h.h + 1:], []) AS turns
            FROM own JOIN h ON h.c = own.c LEFT JOIN own b ON b.c = h.base),
        m AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM r),
        g AS (SELECT c, d, len(turns) AS n, CASE WHEN d = 0 THEN [] ELSE turns[1:d] END AS prefix FROM m),
        nodes AS (
            SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
            FROM g GROUP BY prefix, d),
        kids AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
        f AS (
            SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
                   CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * length(nodes.prefix[nodes.d].text) END AS worth
            FROM nodes LEFT JOIN kids ON kids.prefix = nodes.prefix AND kids.d = nodes.d),
        up AS (SELECT f.*, unnest(range(0, d + 1)) AS k FROM f),
        s AS (
            SELECT CASE WHEN k = 0 THEN [] ELSE prefix[1:k] END AS prefix, k AS d, count(*) FILTER (n_children = 0) AS n_leaves,
                   sum(worth)::BIGINT AS saved_tokens
            FROM up GROUP BY ALL)
        SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
        FROM f JOIN s ON s.prefix = f.prefix AND s.d = f.d
        LEFT JOIN f q ON f.d > 0 AND q.d = f.d - 1 AND q.prefix = CASE WHEN f.d = 1 THEN [] ELSE f.prefix[1:f.d - 1] END""",
}
