"""Registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (
    collocations,
    conversation_trie,
    decontaminate,
    html_text,
    mixing,
    near_dups,
    ngram_quality,
    phrases,
    pii,
    secret_scan,
    substrings,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


#: The rules of the contract.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query(
    "op1_url_filter",
    r"""
    WITH cut AS (
      SELECT page_id,
             coalesce(translate(CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) END,
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) END, '') AS path,
             row_number() OVER () AS n
      FROM pages),
    rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
      ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    fit AS (
      SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
      FROM cut JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
      GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM cut LEFT JOIN fit USING (n)
    """,
)
def op1_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query(
    "op7_mixing",
    r"""
    WITH sized AS (
      SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
      FROM documents),
    totals AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
      FROM sized GROUP BY source),
    levels AS (
      SELECT a.source, a.source_size, a.weight, 2 * a.source_size AS cap,
             ((SELECT sum(source_size) FROM totals) * 1.5::DOUBLE
              - coalesce(sum(2 * b.source_size) FILTER (2 * b.source_size / b.weight < 2 * a.source_size / a.weight), 0))
             / sum(b.weight) FILTER (2 * b.source_size / b.weight >= 2 * a.source_size / a.weight) AS level
      FROM totals a, totals b GROUP BY ALL),
    stop AS (SELECT arg_min(level, cap / weight) AS level, min(cap / weight) AS at FROM levels WHERE cap > level * weight),
    targets AS (
      SELECT l.source, source_size,
             CASE WHEN cap / weight >= stop.at THEN stop.level * weight ELSE cap::DOUBLE END AS target
      FROM levels l, stop)
    SELECT doc_id, size, source_size, target,
           CAST(size * (floor(target / source_size)
             + CASE WHEN ('0x' || substr(md5('mix-1' || chr(31) || coalesce(doc_id::VARCHAR || chr(31), '') || coalesce(text, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE
                         < target / source_size - floor(target / source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    """,
)
def op7_mixing(spark, sf_dir):
    plan = mixing.mixing_plan(table(spark, sf_dir, "documents"))
    return plan.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query("op10_quality")
def op10_quality(spark, sf_dir):
    judged = ngram_quality.judge_quality(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir), rows=False)
    return judged.select("doc_id", "lang", "perplexity", "threshold", "keep")


@query("op6_decontamination")
def op6_decontamination(spark, sf_dir):
    return decontaminate.leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_near_dups")
def op5_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_pii")
def op2_pii(spark, sf_dir):
    spanned = pii.with_spans(table(spark, sf_dir, "documents"))
    counts = [pii.counted("base", k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return spanned.select(
        "row.doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans")
    )


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic"))
    return model.score(docs.select("doc_id", held_out.alias("held_out"), "text")).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op4_phrases")
def op4_phrases(spark, sf_dir):
    return phrases.compare_with_next(table(spark, sf_dir, "documents"))


@query("op8_html_text")
def op8_html_text(spark, sf_dir):
    out = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("row.page_id", "row.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op9_substrings")
def op9_substrings(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query(
    "op11_conversation_trie",
    r"""
    WITH ids AS (
      SELECT conv_id, conv_id - conv_id % 5 AS base,
             CASE WHEN conv_id % 5 = 0 THEN 0 ELSE xor(list_reduce(
               [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT),
               lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
                 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295) % 9 END AS h
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    turns AS (
      SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS key,
             strlen(coalesce(text, '')) AS bytes,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    made AS (
      SELECT ids.conv_id, p, key, bytes FROM ids JOIN turns ON turns.conv_id = ids.base AND p <= h
      UNION ALL
      SELECT conv_id, p + 10, key, bytes FROM ids JOIN turns USING (conv_id) WHERE p > h),
    paths AS (
      SELECT conv_id, bytes,
             CAST(row_number() OVER (PARTITION BY conv_id ORDER BY p) AS BIGINT) AS depth,
             string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY p) AS name
      FROM made
      UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
    lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
    nodes AS (
      SELECT name, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
      FROM paths JOIN lengths USING (conv_id) GROUP BY name),
    parents AS (
      SELECT a.name, a.conv_id AS parent_conv_id, b.name AS child FROM nodes a JOIN nodes b
      ON b.depth = a.depth + 1 AND starts_with(b.name, a.name)),
    kids AS (SELECT nodes.name, count(child) AS n_children FROM nodes LEFT JOIN parents USING (name) GROUP BY nodes.name),
    below AS (
      SELECT a.name, CAST(sum((b.n_convs - 1) * b.bytes) AS BIGINT) AS saved_tokens,
             CAST(count(*) FILTER (kids.n_children = 0) AS BIGINT) AS n_leaves
      FROM nodes a JOIN nodes b ON starts_with(b.name, a.name) JOIN kids ON kids.name = b.name GROUP BY a.name)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    FROM nodes JOIN kids USING (name) JOIN below USING (name) LEFT JOIN parents ON parents.child = nodes.name
    """,
)
def op11_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query(
    "op12_collocations",
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
      FROM documents),
    worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
    spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
    grams AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM spots),
    one AS (SELECT lang, x, count(*) AS f FROM grams GROUP BY ALL),
    two AS (SELECT lang, x, y, count(*) AS f FROM grams WHERE y IS NOT NULL GROUP BY ALL),
    three AS (SELECT lang, x, y, z, count(*) AS f FROM grams WHERE z IS NOT NULL GROUP BY ALL HAVING f >= 10),
    used AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
    inside AS (
      SELECT lang, x, y, max(f) AS longest
      FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY ALL),
    cuts AS (
      SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, l.f AS l, r.f AS r, 1 AS k
      FROM two t JOIN one l ON l.lang = t.lang AND l.x = t.x JOIN one r ON r.lang = t.lang AND r.x = t.y
      LEFT JOIN inside i ON i.lang = t.lang AND i.x = t.x AND i.y = t.y
      WHERE t.f >= 10 AND NOT coalesce(100 * longest >= 50 * t.f, FALSE)
      UNION ALL
      SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, l.f, r.f, 1
      FROM three t JOIN one l ON l.lang = t.lang AND l.x = t.x JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
      UNION ALL
      SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, l.f, r.f, 2
      FROM three t JOIN two l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y JOIN one r ON r.lang = t.lang AND r.x = t.z),
    scored AS (
      SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN used USING (lang) WHERE rank <= 2000
    """,
)
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_secrets")
def op13_secrets(spark, sf_dir):
    found = secret_scan.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    counts = [F.size(secret_scan.of_kind(spans, k)).cast("bigint").alias(f"n_{k}") for k in secret_scan.KINDS]
    base = secret_scan.of_kind(spans, *secret_scan.KINDS[:3])
    return found.select(
        "row.doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(spans).alias("spans")
    )
