"""One registered query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fuzzy_hash import fingerprints
from .html_paths import main_text
from .language_id import fit_languages, held_out, identify
from .line_dedup import dedup_lines
from .lsh_forest import nearest_neighbours
from .minmax_hash import minmax_groups
from .mixture import mix_to_weights
from .multi_index import mine_hard_negatives
from .pii_crf import KINDS, find_personal_data, fit_field, n_spans, span_text
from .piece_nbest import decode_pieces, encode_nbest
from .set_join import jaccard_groups
from .storage import ship_package
from .url_reputation import ALLOW, BLOCK, judge_urls
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
]


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page counts as bad where the label of its number says low quality or toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    judged = judge_urls(_table(spark, sf_dir, "pages"), labels, URL_RULES)
    return judged.select(
        "page_id", "host", "path", "rule", "verdict",
        F.round("bad_share", 6).alias("bad_share"), F.round("bad_bound", 6).alias("bad_bound"),
    )


def op2_set_relation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), k=3, percent=90)


def op3_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(documents, fit_field(documents))
    return found.select(
        "doc_id",
        *(n_spans(F.col("spans"), kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def mix_levels() -> dict[str, Column]:
    """The tree of the mixture: domains (by source), languages in a domain, sources in a language."""
    return {
        "domain": F.when(F.col("source") == "src0", "web")
        .when(F.length("source") <= 4, "reference")
        .otherwise("forum"),
        "language": F.col("lang"),
        "origin": F.col("source"),
    }


def mix_weights() -> dict[str, Column]:
    """Target weights of the nodes among their siblings."""
    return {
        "domain": F.when(F.col("domain") == "web", 5).when(F.col("domain") == "reference", 3).otherwise(2),
        "language": F.when(F.col("language") == "en", 4)
        .when(F.col("language").isin("de", "es", "fr"), 2)
        .otherwise(1),
        "origin": F.lit(1),
    }


def op5_hierarchical_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_to_weights(_table(spark, sf_dir, "documents"), mix_levels(), mix_weights(), max_epochs=3)
    return mixed.select("doc_id", "domain", "language", "origin", "n_tokens", "epoch")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    identifier = fit_languages(documents.where(~held_out()))
    return identify(documents, identifier, [F.col("doc_id"), held_out().alias("held_out")])


def op7_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_nbest(_table(spark, sf_dir, "documents").select("doc_id", "text"), n=4)
    decoded = decode_pieces(encoded)
    return decoded.select(
        "doc_id",
        "n_pieces",
        F.sha2(F.array_join("piece_ids", ","), 256).alias("piece_ids_sha256"),
        "scores",
        F.size("alternatives").cast("long").alias("n_best"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op10_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = main_text(_table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), components=32)


def op13_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_groups(_table(spark, sf_dir, "documents"), k=4, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_reputation": op1_url_reputation,
    "op2_set_relation_join": op2_set_relation_join,
    "op3_hash_prefix_forest": op3_hash_prefix_forest,
    "op4_semi_markov_pii": op4_semi_markov_pii,
    "op5_hierarchical_mixture": op5_hierarchical_mixture,
    "op6_language_id": op6_language_id,
    "op7_piecewise_hash": op7_piecewise_hash,
    "op8_line_dedup": op8_line_dedup,
    "op9_piece_nbest": op9_piece_nbest,
    "op10_consensus_paths": op10_consensus_paths,
    "op11_multi_index": op11_multi_index,
    "op12_whitening": op12_whitening,
    "op13_minmax_hash": op13_minmax_hash,
}


def _groups_sql(k: int, percent: int, columns: str) -> str:
    """Groups of documents by their shingles: all links by a join on shingles, all ways along them by recursion."""
    return rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS words
    FROM documents
), shingles AS (
    SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(words) - {k - 1}, 1) + 1),
                          lambda i: array_to_string(words[i:i + {k - 1}], ' ')))) AS shingle
    FROM docs WHERE len(words) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= {percent} * (x.n + y.n - shared)
), reached AS (
    SELECT doc_id AS node, doc_id AS other FROM docs UNION SELECT node, b FROM reached JOIN links ON other = a
), groups AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node
), degrees AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, {columns}
FROM docs JOIN groups ON node = doc_id LEFT JOIN sizes USING (doc_id) LEFT JOIN degrees ON a = doc_id
"""

SQL: dict[str, str] = {
    "op1_url_reputation": r"""
WITH urls AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), known AS (
    SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad
    FROM labels WHERE quality = 0 OR toxic = 1 OR (quality IS NOT NULL AND toxic IS NOT NULL) GROUP BY doc_id
), named AS (
    SELECT host, bad, regexp_replace(regexp_extract(host, '(?s)^(?:[^@]*@)?(\[[^\]]*\]|[^:@]*)', 1), '\.+$', '') AS name
    FROM urls LEFT JOIN known ON page_id = doc_id
), placed AS (
    SELECT *, string_split(name, '.') AS parts, regexp_full_match(name, '[0-9.]+') OR starts_with(name, '[') AS address,
        array_to_string(parts[-2:], '.') IN
        ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'net.au', 'co.jp', 'ne.jp', 'co.nz', 'com.br', 'co.in') AS two
    FROM named
), hosts AS (
    SELECT host, CASE WHEN address THEN name ELSE array_to_string(CASE WHEN two THEN parts[-3:] ELSE parts[-2:] END, '.') END AS domain,
           CASE WHEN address THEN '[]' ELSE array_to_string(CASE WHEN two THEN parts[-2:] ELSE parts[-1:] END, '.') END AS suffix,
           count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad
    FROM placed GROUP BY ALL
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), s0 AS (
    SELECT *, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM suffixes)::DOUBLE AS mean FROM suffixes
), ks AS (
    SELECT 1 / greatest(0.001, least(0.9, coalesce(sum((bad - n * mean) ** 2 - n * mean * (1 - mean))
           / nullif(sum(n * (n - 1) * mean * (1 - mean)), 0), 0.9))) - 1 AS k FROM s0 WHERE n > 0
), s1 AS (SELECT suffix, (bad + k * mean) / (n + k) AS mean FROM s0, ks
), d0 AS (SELECT * FROM domains JOIN s1 USING (suffix)
), kd AS (
    SELECT 1 / greatest(0.001, least(0.9, coalesce(sum((bad - n * mean) ** 2 - n * mean * (1 - mean))
           / nullif(sum(n * (n - 1) * mean * (1 - mean)), 0), 0.9))) - 1 AS k FROM d0 WHERE n > 0
), d1 AS (SELECT domain, (bad + k * mean) / (n + k) AS mean FROM d0, kd
), h0 AS (SELECT * FROM hosts JOIN d1 USING (domain)
), kh AS (
    SELECT 1 / greatest(0.001, least(0.9, coalesce(sum((bad - n * mean) ** 2 - n * mean * (1 - mean))
           / nullif(sum(n * (n - 1) * mean * (1 - mean)), 0), 0.9))) - 1 AS k FROM h0 WHERE n > 0
), posterior AS (
    SELECT host, bad + k * mean AS a, n - bad + k * (1 - mean) AS b FROM h0, kh
), bounds AS (
    SELECT host, a / (a + b) AS share,
           a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bound
    FROM posterior
), rules(rule, rule_host, rule_path, says) AS (
    VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
           ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
           ('com/de/', 'com', '/de/', 'block')
), fitting AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(says, length(rule)) AS says
    FROM urls, rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       round(share, 6) AS bad_share, round(bound, 6) AS bad_bound
FROM urls JOIN bounds USING (host) LEFT JOIN fitting USING (page_id)
""",
    "op5_hierarchical_mixture": r"""
WITH docs AS (
    SELECT doc_id,
           CASE WHEN source = 'src0' THEN 'web' WHEN length(source) <= 4 THEN 'reference' ELSE 'forum' END AS domain,
           coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
    FROM documents
), leaves AS (
    SELECT 0 AS root, *, tokens * 3 AS capacity,
           CASE domain WHEN 'web' THEN 5 WHEN 'reference' THEN 3 ELSE 2 END AS w_domain,
           CASE WHEN lang = 'en' THEN 4 WHEN lang IN ('de', 'es', 'fr') THEN 2 ELSE 1 END AS w_lang, 1 AS w_source
    FROM (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM docs GROUP BY ALL)
), got0 AS (
    SELECT 0 AS root, least(sum(tokens), sum(capacity))::HUGEINT AS got FROM leaves
), nodes1 AS (
    SELECT l.root, l.domain, sum(capacity)::HUGEINT AS capacity, max(w_domain)::HUGEINT AS weight,
           max(g.got) AS budget
    FROM leaves l JOIN got0 g USING (root) GROUP BY l.root, l.domain
), tested1 AS (
    SELECT *, capacity * (sum(weight) OVER p - coalesce(sum(weight) OVER b, 0))
              <= weight * (budget - coalesce(sum(capacity) OVER b, 0)) AS filled
    FROM nodes1
    WINDOW p AS (PARTITION BY root),
           b AS (PARTITION BY root ORDER BY capacity::DOUBLE / weight::DOUBLE, domain
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared1 AS (
    SELECT *, budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER p AS rest,
           sum(CASE WHEN filled THEN 0 ELSE weight END) OVER p AS open_all,
           sum(CASE WHEN filled THEN 0 ELSE weight END) OVER u AS open_to
    FROM tested1
    WINDOW p AS (PARTITION BY root),
           u AS (PARTITION BY root ORDER BY capacity::DOUBLE / weight::DOUBLE, domain
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), got1 AS (
    SELECT root, domain, CASE WHEN filled THEN capacity
        ELSE rest::HUGEINT * open_to::HUGEINT // open_all::HUGEINT
             - rest::HUGEINT * (open_to - weight)::HUGEINT // open_all::HUGEINT END AS got
    FROM shared1
), nodes2 AS (
    SELECT l.root, l.domain, l.lang, sum(capacity)::HUGEINT AS capacity, max(w_lang)::HUGEINT AS weight,
           max(g.got) AS budget
    FROM leaves l JOIN got1 g USING (root, domain) GROUP BY l.root, l.domain, l.lang
), tested2 AS (
    SELECT *, capacity * (sum(weight) OVER p - coalesce(sum(weight) OVER b, 0))
              <= weight * (budget - coalesce(sum(capacity) OVER b, 0)) AS filled
    FROM nodes2
    WINDOW p AS (PARTITION BY root, domain),
           b AS (PARTITION BY root, domain ORDER BY capacity::DOUBLE / weight::DOUBLE, lang
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared2 AS (
    SELECT *, budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER p AS rest,
           sum(CASE WHEN filled THEN 0 ELSE weight END) OVER p AS open_all,
           sum(CASE WHEN filled THEN 0 ELSE weight END) OVER u AS open_to
    FROM tested2
    WINDOW p AS (PARTITION BY root, domain),
           u AS (PARTITION BY root, domain ORDER BY capacity::DOUBLE / weight::DOUBLE, lang
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), got2 AS (
    SELECT root, domain, lang, CASE WHEN filled THEN capacity
        ELSE rest::HUGEINT * open_to::HUGEINT // open_all::HUGEINT
             - rest::HUGEINT * (open_to - weight)::HUGEINT // open_all::HUGEINT END AS got
    FROM shared2
), nodes3 AS (
    SELECT l.root, l.domain, l.lang, l.source, sum(capacity)::HUGEINT AS capacity, max(w_source)::HUGEINT AS weight,
           max(g.got) AS budget
    FROM leaves l JOIN got2 g USING (root, domain, lang) GROUP BY l.root, l.domain, l.lang, l.source
), tested3 AS (
    SELECT *, capacity * (sum(weight) OVER p - coalesce(sum(weight) OVER b, 0))
              <= weight * (budget - coalesce(sum(capacity) OVER b, 0)) AS filled
    FROM nodes3
    WINDOW p AS (PARTITION BY root, domain, lang),
           b AS (PARTITION BY root, domain, lang ORDER BY capacity::DOUBLE / weight::DOUBLE, source
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared3 AS (
    SELECT *, budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER p AS rest,
           sum(CASE WHEN filled THEN 0 ELSE weight END) OVER p AS open_all,
           sum(CASE WHEN filled THEN 0 ELSE weight END) OVER u AS open_to
    FROM tested3
    WINDOW p AS (PARTITION BY root, domain, lang),
           u AS (PARTITION BY root, domain, lang ORDER BY capacity::DOUBLE / weight::DOUBLE, source
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), got3 AS (
    SELECT root, domain, lang, source, CASE WHEN filled THEN capacity
        ELSE rest::HUGEINT * open_to::HUGEINT // open_all::HUGEINT
             - rest::HUGEINT * (open_to - weight)::HUGEINT // open_all::HUGEINT END AS got
    FROM shared3
), budgets AS (
    SELECT l.domain, l.lang, l.source, g.got // l.tokens AS epochs, g.got % l.tokens AS rest
    FROM leaves l JOIN got3 g USING (domain, lang, source) WHERE g.got > 0 AND l.tokens > 0
), dealt AS (
    SELECT d.*, b.epochs, b.rest, e.epoch, md5('42:' || e.epoch || ':' || d.doc_id) AS key
    FROM docs d JOIN budgets b USING (domain, lang, source), (SELECT unnest(range(4)) AS epoch) e
    WHERE e.epoch <= b.epochs
), filled AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY key
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS before
    FROM dealt
), last AS (
    SELECT domain, lang, source, max(key) AS last_key FROM filled
    WHERE epoch = epochs AND before < rest AND n_tokens > 0 GROUP BY ALL
)
SELECT doc_id, domain, lang AS language, source AS origin, n_tokens, epoch::INT AS epoch
FROM filled LEFT JOIN last USING (domain, lang, source)
WHERE epoch < epochs OR key <= last_key
""",
    "op8_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT doc_id, place, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, min(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
    SELECT k.doc_id, k.place, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op2_set_relation_join": _groups_sql(3, 90, "coalesce(n_links, 0)::BIGINT AS n_links"),
    "op11_multi_index": r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER p)::INT AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW p AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
""",
    "op13_minmax_hash": _groups_sql(4, 80, "doc_id = component_id AS kept"),
}
