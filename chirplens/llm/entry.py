"""The queries of this subpackage, with production parameters, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_text,
    mixing,
    near_dedup,
    pii,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from chirplens.llm.common import table


def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs)
    taken = F.col("size") * F.col("copies")
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op2_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "text",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    # Ties of the hash fall to the checksum; texts need not be shuffled for that.
    placed = sharding.assign(docs.drop("text"), text_col="text_crc32")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, pii.fit_on(docs))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, folder, "documents")
    return token_counts.count_tokens(docs, path, public_tokenizers.PATTERN)


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, folder, "pages"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.with_score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Both passages of a link have a row; ``cut`` marks the one that goes if repeats are cut."""
    links = substring_dedup.repeated_passages(table(spark, folder, "documents"))
    own, other = ["doc_id", "start", "end"], ["other_id", "other_start", "other_end"]

    def row(one: list[str], two: list[str], cut: bool) -> Column:
        named = [F.col(c).alias(n) for c, n in zip(one + two, own + other, strict=True)]
        return F.struct(*named, "similarity", F.lit(cut).alias("cut"))

    return links.select(F.explode(F.array(row(own, other, True), row(other, own, False))).alias("row")).select("row.*")


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), percent=85)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


# The rules of the query, as a list would have them.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, [url_filter.parse_rule(*r) for r in URL_RULES])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integer_vectors(table(spark, folder, "embeddings"), "vec_id", label, "embedding")
    return hard_negatives.mine_hard_negatives(rows, F.col("id") % 100 == 0)


QUERIES = {
    "op1_mix": op1_mix,
    "op2_shards": op2_shards,
    "op3_personal_data": op3_personal_data,
    "op4_decontaminate": op4_decontaminate,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_main_text": op7_main_text,
    "op8_toxicity": op8_toxicity,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_collocations": op11_collocations,
    "op12_url_filter": op12_url_filter,
    "op13_hard_negatives": op13_hard_negatives,
}

# The level is found by trying, in the order in which sources reach their cap, how many are full.
_OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
weighed AS (
  SELECT source, s, 2.0::DOUBLE * s AS most,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM per),
filled AS (
  SELECT *, sum(most) OVER before AS c, (SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER before, 0) AS left_w,
         row_number() OVER (ORDER BY most / w, source NULLS LAST) AS k
  FROM weighed
  WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT k, most / w AS ratio, ((SELECT sum(s) FROM per) * 1.5::DOUBLE - coalesce(c, 0)) / left_w AS level
  FROM filled),
found AS (SELECT level FROM levels WHERE level <= ratio ORDER BY k LIMIT 1),
plan AS (
  SELECT source, s, round(least(most, (SELECT level FROM found) * w), 6) AS target FROM weighed),
drawn AS (
  SELECT d.doc_id, d.size, p.s AS source_size, p.target,
         CASE WHEN p.s > 0 THEN p.target / p.s ELSE 1.0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS chance
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""

_OP5_SQL = """
WITH texts AS (SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM documents)
SELECT doc_id, max(doc_id) OVER own AS keep_id, count(*) OVER own AS group_size,
       doc_id = max(doc_id) OVER own AS kept, sha AS text_sha256
FROM texts WINDOW own AS (PARTITION BY sha)
"""

_OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (
  SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
words AS (SELECT pid, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS pos FROM lists),
rows AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY pid ORDER BY pos)),
counts AS MATERIALIZED (
  SELECT lang, [w1] AS g, count(*) AS f FROM rows GROUP BY lang, w1 HAVING f >= 30
  UNION ALL
  SELECT lang, [w1, w2], count(*) AS f FROM rows WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING f >= 30
  UNION ALL
  SELECT lang, [w1, w2, w3], count(*) AS f FROM rows WHERE w3 IS NOT NULL
  GROUP BY lang, w1, w2, w3 HAVING f >= 30
  UNION ALL
  SELECT lang, [w1, w2, w3, w4], count(*) AS f FROM rows WHERE w4 IS NOT NULL
  GROUP BY lang, w1, w2, w3, w4 HAVING f >= 30),
longer AS (
  SELECT c.lang, c.g[s.s:s.s + m.m - 1] AS g, max(c.f) AS f
  FROM counts c JOIN (VALUES (2), (3)) m(m) ON m.m < len(c.g)
  JOIN (VALUES (1), (2), (3)) s(s) ON s.s + m.m - 1 <= len(c.g)
  GROUP BY ALL),
parts AS MATERIALIZED (
  SELECT c.lang, c.g, c.f, t.k, c.g[1:t.k] AS lg, c.g[t.k + 1:len(c.g)] AS rg
  FROM counts c JOIN (VALUES (1), (2), (3)) t(k) ON t.k < len(c.g)),
cuts AS (
  SELECT p.lang, p.g, p.f AS a, l.f AS l, r.f AS r, p.k, (2000000 * p.f) // (l.f + r.f) AS score
  FROM parts p JOIN counts l ON l.lang = p.lang AND l.g = p.lg
  JOIN counts r ON r.lang = p.lang AND r.g = p.rg
  QUALIFY row_number() OVER (PARTITION BY p.lang, p.g ORDER BY score, p.k) = 1),
kept AS (
  SELECT c.*, array_to_string(c.g, ' ') AS phrase
  FROM cuts c LEFT JOIN longer o USING (lang, g) WHERE o.f IS NULL OR 100 * o.f < 80 * c.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       k.phrase, k.a, k.l, k.r, t.n, k.score::BIGINT AS score
FROM kept k JOIN totals t USING (lang) QUALIFY rank <= 2000
"""

_RULE_ROWS = ", ".join(f"('{v}', '{r.split('/')[0]}', '/{r.split('/', 1)[1]}')" for v, r in URL_RULES)

_OP12_SQL = rf"""
WITH rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
after AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM after)
SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
QUALIFY row_number() OVER (PARTITION BY p.page_id
  ORDER BY length(r.host) - length(replace(r.host, '.', '')) DESC NULLS LAST, length(r.path) DESC) = 1
"""

_OP13_SQL = """
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vecs a JOIN vecs b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

ORACLE_SQL = {
    "op1_mix": _OP1_SQL,
    "op5_exact_dedup": _OP5_SQL,
    "op11_collocations": _OP11_SQL,
    "op12_url_filter": _OP12_SQL,
    "op13_hard_negatives": _OP13_SQL,
}
