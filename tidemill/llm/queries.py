"""The driver's queries over these operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, langid, lexical, mixing, neardup, passages, pieces, quality, repeats, tokenfile, toxicity, urls, vectors

try:  # vocabulary files are parameters; these are the box's
    import public_tokenizers

    TOKENIZER, BYTE_BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
except ImportError:
    TOKENIZER, BYTE_BPE = "/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.curriculum(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("positions")).alias("taken"), F.array_min("positions").alias("position"),
    )
    return mixed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_report(table(spark, sf_dir, "documents"))


def op7_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut(repeats.repeated_spans(table(spark, sf_dir, "documents")))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity.toxicity(docs, toxicity.with_poor(table(spark, sf_dir, "labels")))
    return judged.drop("text").withColumn("kept", ~F.col("toxic"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = tokenfile.write_tokens(docs, tokenfile.tokens_folder(spark), BYTE_BPE, end_id=2)
    return tokenfile.read_tokens(manifest)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vectors.compress(table(spark, sf_dir, "embeddings"))
    rows = vectors.with_label_errors(codes)
    return rows.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vectors.books_digest(books)).alias("codebooks_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


QUERIES = {
    "op10_token_files": op10_token_files,
    "op11_vector_codes": op11_vector_codes,
    "op12_lexical_search": op12_lexical_search,
    "op13_language_id": op13_language_id,
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_fuzzy_passages": op6_fuzzy_passages,
    "op7_long_repeats": op7_long_repeats,
    "op8_toxicity": op8_toxicity,
    "op9_sentencepiece": op9_sentencepiece,
}

_CASE = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"



def _vector_sql() -> str:
    """The rounds unrolled: assignments a0 to a6 and codebooks b0 to b6, one table each."""
    steps = ["""v AS MATERIALIZED (SELECT vec_id, label, [floor(4096 * e::DOUBLE)::BIGINT FOR e IN embedding] AS v FROM embeddings
             WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0)""",
             "x AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] AS x FROM v, range(8) t(p))",
             "b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM x QUALIFY k < 16)"]
    for r in range(vectors.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p, x, min({{'d': d, 'k': k}}) AS best FROM (
            SELECT vec_id, label, x.p, x, k, list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)])::BIGINT AS d
            FROM x JOIN b{r} ON x.p = b{r}.p) GROUP BY ALL)""")
        steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (
            SELECT p, k, list(floor(s / n)::BIGINT ORDER BY i) AS c FROM (
                SELECT p, best.k AS k, i, sum(x[i])::DOUBLE AS s, count(*) AS n FROM a{r}, range(1, 257) t(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY p, k) m
            ON b.p = m.p AND b.k = m.k)""")
    last = vectors.ROUNDS
    return f"""WITH {', '.join(steps)},
        e AS (SELECT vec_id, label, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{last} GROUP BY vec_id, label),
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{last})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e, h"""


SQL = {
    "op11_vector_codes": _vector_sql(),
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256({_NORM}) AS text_sha256, {_NORM} AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)""",
    "op12_lexical_search": rf"""
        WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_CASE}), '{_TERM}')) AS term FROM documents),
             q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_CASE}), '{_TERM}')) AS term FROM benchmark),
             d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id), a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
             p AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
             w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term),
             s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
                   FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (doc_id), a GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10""",
}
