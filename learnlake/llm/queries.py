"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.llm import (
    collocation, covertree, langid, mixing, onebit, packing, pii, pivots, quality, simhash, toxicity, urlfilter, wrapper,
)
from learnlake.llm.frames import fold, table


def held(n: int, remainder: int):
    return F.coalesce(fold(F.col("doc_id"), n) == remainder, F.lit(False)).alias("held_out")


def learned(n: int, remainder: int):
    return fold(F.col("doc_id"), n) != remainder


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs, learned(3, 1))
    return langid.predict(docs, model, ["doc_id"]).select("doc_id", held(3, 1), "lang_pred", "score")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, learned(5, 0), langid.fit(docs, learned(5, 0), scores=False))
    scored = toxicity.predict(docs, model, ["doc_id"])
    return scored.select("doc_id", held(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return onebit.nearest(table(spark, folder, "embeddings"), asks=100, top=10)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.predict(docs, quality.fit(docs, labels, learned(4, 2)), ["doc_id"])
    return scored.select("doc_id", held(4, 2), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# the rules that this query judges by
RULES = [
    urlfilter.Rule("allow", "com", "/"),
    urlfilter.Rule("block", "example.com", "/en/"),
    urlfilter.Rule("allow", "www.example.com", "/en/"),
    urlfilter.Rule("block", "net", "/es/"),
    urlfilter.Rule("block", "net", "/fr/"),
]


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    judged = urlfilter.judge(pages, urlfilter.fit(pages.select("url"), RULES), ["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return wrapper.extract(table(spark, folder, "pages"), ["page_id", "url"])


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.cluster(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_largest_products(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.largest(table(spark, folder, "embeddings"), asks=50, top=5)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), tokenizer_path())
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, folder, "documents")))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocation.mine(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.compress(table(spark, folder, "embeddings"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_toxicity, op3_mixing, op4_nearest, op5_quality, op6_url_filter, op7_html_text, op8_simhash,
        op9_largest_products, op10_packing, op11_pii, op12_collocations, op13_vector_codes,
    )
}

def vector_codes_sql(rounds: int = pivots.ROUNDS, parts: int = pivots.PARTS, entries: int = pivots.ENTRIES) -> str:
    """The rounds one after the other, every part against every entry."""
    steps = [f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
    [CAST(floor({pivots.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
  SELECT n, p, e[p * (len(e) // {parts}) + 1 : (p + 1) * (len(e) // {parts})] AS x FROM v, range({parts}) t(p)
), book0 AS MATERIALIZED (SELECT p, n - 1 AS entry, x FROM parts WHERE n <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""best{k} AS MATERIALIZED (
  SELECT n, p, min(struct_pack(
    d := CAST(list_sum([(c[1] - c[2]) * (c[1] - c[2]) FOR c IN list_zip(parts.x, book{k}.x)]) AS BIGINT), entry := entry)) AS b
  FROM parts JOIN book{k} USING (p) GROUP BY n, p
)""")
        if k < rounds:
            steps.append(f"""sum{k} AS (
  SELECT p, b.entry AS entry, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS c
  FROM best{k} JOIN parts USING (n, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY ALL
), mean{k} AS (
  SELECT p, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS x FROM sum{k} GROUP BY p, entry
), book{k + 1} AS MATERIALIZED (
  SELECT p, entry, coalesce(mean{k}.x, book{k}.x) AS x FROM book{k} LEFT JOIN mean{k} USING (p, entry)
)""")
    steps.append(f"""coded AS (
  SELECT n, string_agg(printf('%02x', b.entry), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error
  FROM best{rounds} GROUP BY n
)""")
    return ",".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256
FROM v JOIN coded USING (n)
"""


ORACLES: dict[str, str] = {
    "op13_vector_codes": vector_codes_sql(),
    "op12_collocations": f"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, * FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\v\\f\\r]')) AS t
    FROM documents)
), words AS (
  SELECT piece, lang, unnest(w) AS w, generate_subscripts(w, 1) AS i
  FROM (SELECT piece, lang, regexp_extract_all(t, '[^ \\t]+') AS w FROM pieces)
), leads AS MATERIALIZED (
  SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY piece ORDER BY i)
), f AS MATERIALIZED (
  SELECT *, concat_ws(' ', w1, w2, w3, w4) AS phrase FROM (
    SELECT lang, 1 AS m, w1, NULL AS w2, NULL AS w3, NULL AS w4, count(*) AS a FROM leads GROUP BY lang, w1
    UNION ALL SELECT lang, 2, w1, w2, NULL, NULL, count(*) FROM leads WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
    UNION ALL SELECT lang, 3, w1, w2, w3, NULL, count(*) FROM leads WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3
    UNION ALL SELECT lang, 4, w1, w2, w3, w4, count(*) FROM leads WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4
  ) WHERE m = 1 OR a >= {collocation.SUPPORT}
), total AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT * FROM f WHERE m > 1
), cut AS (
  SELECT lang, phrase, a, 1 AS k, w1 AS lp, concat_ws(' ', w2, w3, w4) AS rp FROM candidates
  UNION ALL SELECT lang, phrase, a, 2, concat_ws(' ', w1, w2), concat_ws(' ', w3, w4) FROM candidates WHERE m > 2
  UNION ALL SELECT lang, phrase, a, 3, concat_ws(' ', w1, w2, w3), w4 FROM candidates WHERE m > 3
), left_ AS MATERIALIZED (
  SELECT cut.*, f.a AS l FROM cut JOIN f ON f.lang = cut.lang AND f.phrase = lp
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l, f.a AS r,
    CAST((CAST({collocation.SCORE} AS HUGEINT) * c.a) // (l + f.a) AS BIGINT) AS score
  FROM left_ c JOIN f ON f.lang = c.lang AND f.phrase = rp
), weakest AS (
  SELECT DISTINCT ON (lang, phrase) * FROM cuts ORDER BY lang, phrase, score, k
), inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([concat_ws(' ', w1, w2), concat_ws(' ', w2, w3)]) AS phrase FROM candidates WHERE m > 2
    UNION ALL SELECT lang, a, unnest([concat_ws(' ', w3, w4), concat_ws(' ', w1, w2, w3), concat_ws(' ', w2, w3, w4)])
    FROM candidates WHERE m > 3
  ) GROUP BY lang, phrase
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inner_ USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < {collocation.COVER} * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {collocation.TOP}
""",
    "op6_url_filter": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM named
), rules(verdict, host, path) AS (
  VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}
), fits AS (
  SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (n)
""",
    "op9_largest_products": """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, r.e)]) AS BIGINT) AS score
  FROM (SELECT DISTINCT ON (vec_id) * FROM v WHERE vec_id % 50 = 0) q
  JOIN v r ON r.vec_id <> q.vec_id AND len(r.e) = len(q.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
