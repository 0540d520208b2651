"""Registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bag_search, bpe, contamination, digests, html_text, jaccard, language, lengths, licences, lm_scores, quality, toxicity,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact totals of all documents' encoded lengths at every context limit that occurs."""
    docs = _read(spark, sf_dir, "documents")
    return lengths.suffix_sums(lengths.length_histogram(lengths.encoded_lengths(docs)))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document lies in benchmark passages, and of which items."""
    marked = contamination.find_passages(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), keep=("doc_id",)
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    hit = F.when(F.size("matches") > 0, contamination.covered(F.col("matches"))).otherwise(F.lit(0).cast("long"))
    return marked.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        contamination.contaminated(hit, F.col("n_words")).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT item_id, w, least(13, len(w)) AS k,
                 unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
          FROM items WHERE len(w) > 0)
),
grams AS (
    SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
          FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
),
found AS (SELECT doc_id, item_id, i, k FROM grams JOIN windows USING (k, gram)),
hits AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM found) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, and the text that they decode to, as digests."""
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), with_text=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; learns from labels outside the held-out fold."""
    docs = _read(spark, sf_dir, "documents")
    return toxicity.predictions(docs, toxicity.learn(docs, _read(spark, sf_dir, "labels")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are linked by similar shingle sets."""
    linked = jaccard.link_documents(_read(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id")


OP6_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.doc_id, steps.y FROM reach r JOIN steps ON r.other = steps.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r USING (doc_id) GROUP BY ALL
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; learns from labels outside the held-out fold."""
    docs = _read(spark, sf_dir, "documents")
    return quality.predictions(docs, quality.learn(docs, _read(spark, sf_dir, "labels")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents; the largest id of each stays."""
    return digests.exact_groups(_read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; learns from texts and languages outside the held-out fold."""
    docs = _read(spark, sf_dir, "documents")
    return language.predictions(docs, language.learn(docs))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of all documents; learns from texts outside the held-out fold."""
    return lm_scores.score(_read(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, their errors and the digest of the codebooks."""
    coded = vector_codes.compress(_read(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op11_sql() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cut AS MATERIALIZED (
    SELECT vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS r(p))""",
        f"""c0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM cut QUALIFY k < {entries})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} AS MATERIALIZED (
    SELECT vec_id, p, min((d, k)) AS best FROM (
        SELECT vec_id, p, k, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM cut JOIN c{i} USING (p))
    GROUP BY vec_id, p)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
    SELECT c{i}.p, c{i}.k, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
        SELECT p, k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM (
            SELECT p, best[2] AS k, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n
            FROM near{i} JOIN cut USING (vec_id, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS j)
            GROUP BY ALL)
        GROUP BY p, k) m USING (p, k))"""
            )
    steps.append(
        f"""coded AS (
    SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id),
books AS (
    SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{rounds})"""
    )
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and covered licence templates of all documents."""
    found = licences.scan(_read(spark, sf_dir, "documents"), keep=("doc_id",))
    starts = F.transform("places", lambda p: p["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licences.label_text(F.col("places")).alias("base_labels"),
        licences.label_text(F.col("places"), F.col("spans")).alias("labels"),
        F.col("cover").alias("score"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, of all documents."""
    return bag_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


OP13_SQL = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
terms AS (SELECT doc_id, unnest(w) AS term FROM words),
corpus AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM words),
wanted AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
counts AS (
    SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, corpus GROUP BY term, docs),
lengths AS (
    SELECT doc_id, 100 - 90 + (90 * len(w) * docs) // total AS m FROM words, corpus WHERE len(w) > 0),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_html_extraction": op4_html_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_language_id": op9_language_id,
    "op10_lm_scores": op10_lm_scores,
    "op11_vector_codes": op11_vector_codes,
    "op12_licence_scan": op12_licence_scan,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op6_jaccard_join": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_vector_codes": _op11_sql(),
    "op13_lexical_search": OP13_SQL,
}
