"""One query per operator of this package, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    codes,
    decontam,
    html_text,
    mixing,
    quality,
    ranked,
    repeats,
    sharding,
    simhash,
    toxicity,
    urls,
    vectors,
    warc,
)
from tidemark.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


MIX_SQL = r"""
  WITH d AS (SELECT doc_id, source,
                    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
  s AS (SELECT source, sum(size)::DOUBLE AS source_size,
               [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
        FROM d GROUP BY source),
  r AS (SELECT *, 3 * source_size AS cap,
               sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS remaining,
               sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left
        FROM s WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  f AS (SELECT arg_min(remaining / w_left, cap / w) AS level FROM r WHERE cap >= w * (remaining / w_left)),
  t AS (SELECT source, source_size, least(cap, coalesce(w * level, cap)) AS target FROM r, f),
  c AS (SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0 END AS copies,
               ('0x' || substr(md5(coalesce(source, '') || '|7'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM t),
  k AS (SELECT d.doc_id, d.size, c.source_size, c.target, c.copies, c.u,
               row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k
        FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
  SELECT doc_id, size, source_size::BIGINT AS source_size, round(target, 3) AS target,
         (size * (floor(k * copies + u) - floor((k - 1) * copies + u)))::BIGINT AS taken
  FROM k
"""


@query("op3_systematic_mix", MIX_SQL)
def op3(spark, sf):
    made = mixing.mix(table(spark, sf, "documents"))
    return made.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


@query("op5_simhash_pigeonring")
def op5(spark, sf):
    made = simhash.near_duplicates(table(spark, sf, "documents"))
    return made.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_histogram_shards")
def op7(spark, sf):
    made = sharding.shard(table(spark, sf, "documents"))
    return made.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


HIT_SQL = r"""
  WITH w AS (SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
  i AS (SELECT item_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
  p AS (SELECT DISTINCT item_id, least(len(words), 10) AS size,
               array_to_string(list_slice(words, k, k + least(len(words), 10) - 1), ' ') AS phrase
        FROM i, LATERAL (SELECT unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS k) WHERE len(words) > 0),
  l AS (SELECT DISTINCT size FROM p),
  g AS (SELECT doc_id, size, k, array_to_string(list_slice(words, k, k + size - 1), ' ') AS phrase
        FROM w, l, LATERAL (SELECT unnest(range(1, greatest(len(words) - size + 2, 1))) AS k)),
  m AS (SELECT g.doc_id, g.size, g.k, p.item_id FROM g JOIN p USING (size, phrase)),
  h AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM m) GROUP BY doc_id),
  n AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
  SELECT w.doc_id, coalesce(len(w.words), 0)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
         coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
         coalesce(h.n_hit, 0) > 0 AS contaminated
  FROM w LEFT JOIN h ON w.doc_id = h.doc_id LEFT JOIN n ON w.doc_id = n.doc_id
"""


@query("op8_wu_manber", HIT_SQL)
def op8(spark, sf):
    found = decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), unnamed=True)
    length = lambda s: s["end"] - s["first"]
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + length(s))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@query("op9_quality_waves")
def op9(spark, sf):
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op1_tag_path_text")
def op1(spark, sf):
    return html_text.with_main_text(table(spark, sf, "pages"))


@query("op4_cover_tree_links", """
  WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  u AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS size FROM e),
  p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.93),
  r AS (WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM reach r JOIN p ON r.b = p.a)
        SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
  n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
  SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, coalesce(r.component_id, e.vec_id) AS component_id,
         coalesce(r.component_id, e.vec_id) = e.vec_id AS kept
  FROM e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN r ON e.vec_id = r.a
""")
def op4(spark, sf):
    return vectors.near_vectors(table(spark, sf, "embeddings"))


@query("op6_redirect_verdicts", r"""
  WITH h AS (SELECT page_id,
                    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
  r(rule, name, start, rule_verdict) AS (VALUES ('net/', 'net', '/', 'block'),
       ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'),
       ('org/fr/', 'org', '/fr/', 'allow')),
  f AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
               arg_max(rule_verdict, length(rule)) AS rule_verdict
        FROM h LEFT JOIN r ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
        GROUP BY page_id, host, path)
  SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM f
""")
def op6(spark, sf):
    return urls.verdicts(table(spark, sf, "pages"))


@query("op2_warc_index", """
  WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
  d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS sha,
               min(page_id) OVER (PARTITION BY payload) AS first FROM p),
  h AS (SELECT *, list_transform(range(0, 8),
                 lambda i: ('0x' || substr(sha, (1 + 5 * i)::INT, 5))::BIGINT) AS parts FROM d)
  SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
         array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ((v >> s) & 31))::INT, 1)), '')), '') AS payload_digest,
         CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id <> first THEN first END AS refers_to
  FROM h
""")
def op2(spark, sf):
    made = warc.archive_round_trip(table(spark, sf, "pages"))
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_suffix_repeats")
def op10(spark, sf):
    return repeats.remove_repeats(table(spark, sf, "documents"))


@query("op11_bag_search", r"""
  WITH d AS (SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
  i AS (SELECT item_id, word, count(*)::BIGINT AS times
        FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY ALL),
  n AS (SELECT doc_id, len(words)::BIGINT AS n FROM d WHERE len(words) > 0),
  g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM n),
  t AS (SELECT doc_id, word, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(words) AS word FROM d)
        WHERE word IN (SELECT word FROM i) GROUP BY ALL),
  w AS (SELECT word, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM t, g GROUP BY word),
  s AS (SELECT item_id, doc_id,
               sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // length)))))::BIGINT
                 AS score
        FROM t JOIN w USING (word) JOIN n USING (doc_id) JOIN i USING (word), g GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
  SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
""")
def op11(spark, sf):
    return ranked.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [f"""k AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    x AS MATERIALIZED (
      SELECT vec_id, label, part, list_slice(v, 1 + part * (len(v) // {parts}), (part + 1) * (len(v) // {parts})) AS x
      FROM k, (SELECT unnest(range({parts})) AS part)),
    c0 AS MATERIALIZED (
      SELECT part, x AS c, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM x
      QUALIFY entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
      SELECT vec_id, part, any_value(label) AS label, any_value(x) AS x, arg_min(entry, (far, entry)) AS entry,
             min(far) AS far
      FROM (SELECT x.*, entry, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) ** 2))::BIGINT AS far
            FROM x JOIN c{r} USING (part)) GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (
      SELECT part, entry, list(floor(total::DOUBLE / n)::BIGINT ORDER BY i) AS c
      FROM (SELECT part, entry, i, sum(x[i]) AS total, count(*) AS n
            FROM a{r}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY ALL) GROUP BY part, entry),
    c{r + 1} AS MATERIALIZED (
      SELECT part, entry, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m USING (part, entry))""")
    return "WITH " + ",\n    ".join(steps) + f""",
    s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
          FROM c{rounds}),
    e AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
                 sum(far)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM e, s"""


@query("op12_ball_codes", _codes_sql())
def op12(spark, sf):
    return codes.code_report(table(spark, sf, "embeddings"))


@query("op13_kneser_ney_toxicity")
def op13(spark, sf):
    return toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
