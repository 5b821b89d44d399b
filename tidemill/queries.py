"""The driver's queries over the synthetic tables, and DuckDB SQL that gives the same rows.

documents stand for comments (doc_id: comment and order, source: post, lang: platform, text: body),
labels for a labeller, conversations for posts with replies, pages for page source, events for requests.
"""

from __future__ import annotations

import itertools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates, jsontext, lexicon
from .functions import text as T
from .operators import audit, capacity, filters, groups, label, places, report, schedule, summarize
from .plans import curate, ledger, models
from .rules import EMOTICONS, FIRST_EMOTICONS, FIRST_UI_PHRASES, KEPT_LETTERS, QUOTAS, SAMPLE, UI_PHRASES
from .sources import html, readers, tables, writers

QUERIES: dict = {}
SQL: dict[str, str] = {}
NOW = "TIMESTAMP '2024-03-31 10:00:00'"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/{name}.parquet")
    return readers.spread(rows) if name == "documents" else rows


def comments(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return read(spark, d, "documents").select(c("doc_id").alias("comment_id"), c("source").alias("post_id"), c("text").alias("comment_raw"), c("lang").alias("platform"))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    names = F.when(F.col("toxic") == 1, SAMPLE.first).when(F.col("quality") == 0, SAMPLE.second).otherwise(SAMPLE.neutral)
    return comments(spark, d).join(read(spark, d, "labels").select(F.col("doc_id").alias("comment_id"), names.alias("label")), "comment_id")


# --- SQL pieces -----------------------------------------------------------------------------------

S = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
W = r"[\p{L}\p{M}\p{N}_]"


def s_sub(x: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{by}', '{flags}')"


def s_collapse(x: str) -> str:
    return f"trim({s_sub(x, S + '+', ' ')})"


def s_chain(x: str, patterns, by: str, icase: bool = True) -> str:
    for p in patterns:
        x = s_sub(x, ("(?i)" if icase else "") + p, by)
    return x


URL = r"https?://\S+|www\.\S+|\S+\.(com|org|net|co|vn|io)(/\S*)?"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
PHRASES, FIRST_PHRASES = ([T.quoted(p) for p in x] for x in (UI_PHRASES, FIRST_UI_PHRASES))


def s_denoise(x: str) -> str:
    for p in (URL, "<[^>]+>", r"@[\p{L}\p{M}\p{N}_.]+", rf"#{W}+"):
        x = s_sub(x, p, " ")
    return s_collapse(s_chain(x, PHRASES, " "))


KEEP = rf"[^{KEPT_LETTERS}a-zA-Z0-9\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+"
EMOTI = "(?i)" + "|".join(EMOTICONS)


def s_words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '{S}+'), lambda w: regexp_matches(w, '[a-zA-ZÀ-ỹ0-9]')))"


def s_tokens(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '{S}+'), lambda w: w <> ''))"


#: Letters squeezed, as a table: one row per document.  Characters are numbered once per text.
SEVEN_CTE = f"""
    noisy AS (SELECT doc_id, source, {s_denoise(s_collapse(s_sub(s_sub("lower(text)", EMOJI, " "), EMOTI, " ")))} AS x FROM documents),
    chars AS (SELECT doc_id, unnest(string_split(x, '')) AS c, generate_subscripts(string_split(x, ''), 1) AS i FROM noisy),
    kept AS (SELECT doc_id, c, i, lag(c, 1) OVER w AS p, lag(c, 2) OVER w AS q FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    squeezed AS (SELECT doc_id, string_agg(c, '' ORDER BY i) FILTER (WHERE NOT (regexp_full_match(c, '\\p{{L}}') AND coalesce(c = p AND c = q, false))) AS x FROM kept GROUP BY doc_id),
    seven AS (SELECT n.doc_id, n.source, {s_collapse(s_collapse(s_sub("coalesce(s.x, '')", KEEP, " ")))} AS clean FROM noisy n LEFT JOIN squeezed s USING (doc_id))"""


MARK = r"[\^'`~\",.]"


def s_runs(x: str) -> str:
    """A text as runs of word characters, of stray marks, and of anything else."""
    pattern = rf"{W}+|{MARK}+|[^\p{{L}}\p{{M}}\p{{N}}_\^'`~\",.]+".replace("'", "''")
    return f"regexp_extract_all({x}, '{pattern}')"


def s_orphan(name: str, source: str) -> str:
    """A table (doc_id, x) of the texts x of source without stray marks.  Of a run of marks, one that touches
    a word on its left or right stays; the others are one space.  There are no lookarounds here, so runs look at
    their neighbours."""
    mark = MARK.replace("'", "''")
    return f"""
    {name}_runs AS (SELECT doc_id, unnest({s_runs('x')}) AS r, generate_subscripts({s_runs('x')}, 1) AS i FROM {source}),
    {name}_next AS (SELECT doc_id, i, r, regexp_matches(r, '^{mark}') AS mark, coalesce(lag(regexp_matches(r, '^{W}')) OVER o, false)::INT AS lw, coalesce(lead(regexp_matches(r, '^{W}')) OVER o, false)::INT AS rw
        FROM {name}_runs WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    {name}_one AS (SELECT doc_id, string_agg(CASE WHEN NOT mark OR length(r) <= lw + rw THEN r ELSE left(r, lw) || ' ' || right(r, rw) END, '' ORDER BY i) AS x FROM {name}_next GROUP BY doc_id),
    {name} AS (SELECT s.doc_id, coalesce(o.x, '') AS x FROM {source} s LEFT JOIN {name}_one o USING (doc_id))"""


def s_first_clean(source: str = "text") -> str:
    """The first stage's cleaning as tables, the last of which is clean (doc_id, source, lang, raw, text)."""
    x = s_sub(s_sub(s_sub(source, URL, ""), r"media\d*\.giphy\.com", ""), "<[^>]+>", "")
    x = s_sub(x, r"@[\p{L}\p{M}\p{N}_.]+", "")
    for word in ("ig", "instagram"):
        x = s_sub(x, rf"\({S}*{word}{S}+[\p{{L}}\p{{M}}\p{{N}}_.]+{S}*\)", "")
    x = s_chain(s_chain(s_sub(x, EMOJI, ""), FIRST_EMOTICONS, "", icase=False), FIRST_PHRASES, "")
    return f"""noisy AS (SELECT doc_id, {x} AS x FROM documents), {s_orphan('tidy', 'noisy')},
    clean AS (SELECT d.doc_id, source, lang, d.text AS raw, lower({s_collapse('x')}) AS text FROM documents d JOIN tidy USING (doc_id))"""


# --- text -----------------------------------------------------------------------------------------


#: What the table's texts lack: each text is put between two copies of it where a query asks for marks.
MARKS = "<p class='x'>Hi</p> media3.giphy.com/a ( ig some.name_1 )(Instagram no)(instagram x.y) #tag_1#Tàg 🙂🚀✂ :)) =((( <3 :v :V =]] :DD E\u0301a\u0300"


def _text(name: str, f, sql: str | None, marks: bool = False) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = read(spark, d, "documents")
        rows = rows.withColumn("text", F.concat(F.lit(MARKS), "text", F.lit(MARKS))) if marks else rows
        return rows.select("doc_id", f(F.col("text")).alias("value"))

    QUERIES[name] = run
    if sql:
        quoted = MARKS.replace("'", "''")
        SQL[name] = f"SELECT doc_id, {sql} AS value FROM " + (f"(SELECT doc_id, '{quoted}' || text || '{quoted}' AS text FROM documents)" if marks else "documents")


_text("text_lower_ws", lambda c: T.collapse(T.lower(c)), s_collapse("lower(text)"))
_text("strip_urls", T.strip_urls, s_sub("text", URL, " "))
_text("strip_giphy", T.strip_giphy, s_sub("text", r"media\d*\.giphy\.com", ""), marks=True)
_text("strip_html", T.strip_tags, s_sub("text", "<[^>]+>", " "), marks=True)
_text("strip_mentions", T.strip_mentions, s_sub("text", r"@[\p{L}\p{M}\p{N}_.]+", " "))
_text("strip_instagram", T.strip_instagram, s_sub(s_sub("text", rf"\({S}*ig{S}+[\p{{L}}\p{{M}}\p{{N}}_.]+{S}*\)", ""), rf"\({S}*instagram{S}+[\p{{L}}\p{{M}}\p{{N}}_.]+{S}*\)", ""), marks=True)
_text("strip_hashtags", T.strip_hashtags, s_sub("text", rf"#{W}+", " "), marks=True)
_text("strip_emoji", T.strip_emoji, s_sub("text", EMOJI, " "), marks=True)
_text("strip_emoticons", T.strip_emoticons, s_sub("text", EMOTI, " "), marks=True)
_text("strip_first_emoticons", T.strip_first_emoticons, s_chain("text", FIRST_EMOTICONS, "", icase=False), marks=True)
_text("strip_ui", T.strip_phrases, s_chain("text", PHRASES, " "))
_text("denoise", lambda c: T.collapse(T.strip_phrases(T.strip_hashtags(T.strip_mentions(T.strip_tags(T.strip_urls(c)))))), s_denoise("text"))
_text("orphan_punct", T.orphan_punct, None)
SQL["orphan_punct"] = f"WITH raw AS (SELECT doc_id, text AS x FROM documents), {s_orphan('tidy', 'raw')} SELECT doc_id, x AS value FROM tidy"
_text("minimal_clean", lambda c: T.minimal_clean(c, True), None)
SQL["minimal_clean"] = f"WITH {s_first_clean('nfc_normalize(text)')} SELECT doc_id, text AS value FROM clean"
_text("nfc_lower", lambda c: T.lower(T.nfc(c)), "lower(nfc_normalize(text))", marks=True)
_text("strip_punct", T.strip_punct, s_collapse(s_sub("text", KEEP, " ")))
_text("prompt_safe", T.prompt_safe, s_sub("translate(" + s_sub(s_sub(s_sub(s_sub("text", f"^{S}+|{S}+$", ""), r"https?://\S+", "[URL]"), r"\S+@\S+", "[EMAIL]"), r"\d{3}-?\d{3}-?\d{4}", "[PHONE]") + ", '\"' || chr(10) || chr(13), '''  ')", "[!@#$%^&*()]+", " "))
_text("lexical_normalize", lambda c: T.lexical(T.lower(c), SAMPLE.lexicon), None)
SQL["lexical_normalize"] = f"""
    WITH t AS (SELECT doc_id, replace(replace(replace(lower(text), 'c++', 'cpp'), ':3', 'cat'), '***', 'star') AS x FROM documents),
    r AS (SELECT doc_id, unnest({s_runs('x')}) AS r, generate_subscripts({s_runs('x')}, 1) AS i FROM t)
    SELECT t.doc_id, coalesce(string_agg(CASE r WHEN 'ths' THEN 'this' WHEN 'ou' THEN 'you' WHEN 'nd' THEN 'and' ELSE r END, '' ORDER BY i), '') AS value FROM t LEFT JOIN r USING (doc_id) GROUP BY t.doc_id"""
_text("truncate_preview", lambda c: T.ellipsis(c, 100), "CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END")
_text("truncate_fraction", lambda c: T.fraction(c, 0.75), "substr(text, 1, CAST(floor(length(text) * 0.75) AS INT))")
_text("csv_cell", lambda c: writers.csv_line(F.col("doc_id"), c), "'\"' || doc_id || '\",\"' || replace(text, '\"', '\"\"') || '\"'")
_text("video_clean", T.video_clean, None)
_text("thread_clean", T.thread_clean, None)
_text("has_url", T.has_url, r"regexp_matches(text, '(?i)(https?://\S+)|(www\.\S+)|(\S+\.(com|org|net|edu|gov|io|co|tv|me|ly|be|gl)\S*)')")
_text("valid_video_comment", T.valid_video_comment, None)
_text("removal_reason", T.removal_reason, f"CASE {s_words('text')} WHEN 0 THEN 'Empty comment after cleaning' WHEN 1 THEN 'Single word comment' WHEN 2 THEN 'Two words comment' WHEN 3 THEN 'Three words comment' ELSE 'Other reason' END")
_text("special_pattern", lambda c: T.special(c, ("the", "///")), "contains(lower(text), 'the') OR contains(lower(text), '///')")
_text("comment_hash", lambda c: T.comment_id(F.col("source"), c, F.col("lang"), "t"), "'tc_' || md5(source || '|' || substr(text, 1, 100) || '|' || lang || '|t')")
_text("author_or", lambda c: T.author_or(F.when(F.col("doc_id") % 3 > 0, F.col("source")), F.col("doc_id")), "CASE WHEN doc_id % 3 > 0 THEN source ELSE 'deleted_' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) END")
_text("masked_slug", lambda c: F.concat_ws("/", T.masked(F.col("source")), T.slug(F.concat(F.col("lang"), F.lit("-2.5"))), T.version_token(F.concat(F.lit("data/v3/"), F.col("source")))), "'...' || right(source, 4) || '/' || lang || '_2_5/v3'")
_text("fix_breaks", readers.fix_breaks, "replace(replace(text, chr(13), chr(10)), chr(10) || chr(10), chr(10))")


#: 4,672 slang words by rule, each of which becomes itself in angle brackets.
WIDE = tuple((w, f"<{w}>") for n in (2, 3, 4) for w in map("".join, itertools.product("aeinorst", repeat=n)))


@query(f"""
    WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{W}+|[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '{W}+|[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), 1) AS i FROM documents)
    SELECT d.doc_id, coalesce(string_agg(CASE WHEN regexp_full_match(w, '[aeinorst]{{2,4}}') THEN '<' || w || '>' ELSE w END, '' ORDER BY i), '') AS value FROM documents d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id""")
def lexical_wide(spark, d):
    return read(spark, d, "documents").select("doc_id", lexicon.rewritten(T.lower(F.col("text")), WIDE).alias("value"))


@query(f"SELECT doc_id, {s_words('text')} AS words, {s_tokens('text')} AS tokens, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS estimate FROM documents")
def word_counts(spark, d):
    c = F.col("text")
    return read(spark, d, "documents").select("doc_id", T.count_words(c).alias("words"), T.count_tokens(c).alias("tokens"), T.token_estimate(c).alias("estimate"))


@query("""
    WITH l AS (SELECT doc_id, lower(text) AS x FROM documents),
    chars AS (SELECT doc_id, unnest(string_split(x, '')) AS c, generate_subscripts(string_split(x, ''), 1) AS i FROM l),
    kept AS (SELECT doc_id, c, i, lag(c, 1) OVER w AS p, lag(c, 2) OVER w AS q FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i))
    SELECT doc_id, coalesce(string_agg(c, '' ORDER BY i) FILTER (WHERE NOT (regexp_full_match(c, '\\p{L}') AND coalesce(c = p AND c = q, false))), '') AS value FROM kept GROUP BY doc_id""")
def squeeze_letters(spark, d):
    return read(spark, d, "documents").where("length(text) > 0").select("doc_id", T.squeeze(T.lower(F.col("text"))).alias("value"))


@query(f"WITH {SEVEN_CTE} SELECT doc_id, clean FROM seven")
def clean_seven_step(spark, d):
    return read(spark, d, "documents").select("doc_id", T.seven_step(F.col("text")).alias("clean"))


@query(f"WITH {SEVEN_CTE} SELECT min(doc_id) AS comment_id, clean AS comment_clean FROM seven GROUP BY clean")
def clean_dedup_first(spark, d):
    return curate.final_stage(comments(spark, d), [F.col("comment_id")]).select("comment_id", "comment_clean")


@query(f"""
    WITH {SEVEN_CTE}, firsts AS (SELECT min(doc_id) AS doc_id FROM seven GROUP BY clean),
    n AS (SELECT toxic, count(*) AS n FROM firsts LEFT JOIN labels USING (doc_id) GROUP BY toxic)
    SELECT toxic, n, n * 100.0 / sum(n) OVER () AS percent FROM n""")
def label_distribution(spark, d):
    """The flagship: clean, keep the first of each cleaned text, label, count with percents."""
    kept = curate.final_stage(comments(spark, d), [F.col("comment_id")])
    rows = kept.join(read(spark, d, "labels").withColumnRenamed("doc_id", "comment_id"), "comment_id", "left")
    return report.shares(rows, "toxic").select("toxic", "n", F.round("percent", 9).alias("percent"))


SQL["label_distribution"] = SQL["label_distribution"].replace("n * 100.0 / sum(n) OVER () AS percent", "round(n * 100.0::DOUBLE / sum(n) OVER (), 9) AS percent")

# --- filters and reports --------------------------------------------------------------------------


@query(f"SELECT doc_id AS comment_id, {s_words('text')} <= 300 AS kept FROM documents")
def long_filter(spark, d):
    kept, gone = filters.filter_long(comments(spark, d))
    return kept.select("comment_id", F.lit(True).alias("kept")).union(gone.select("comment_id", F.lit(False)))


@query(f"SELECT doc_id AS comment_id, {s_words('text')} > 3 OR contains(lower(text), 'the') AS kept FROM documents")
def short_filter(spark, d):
    kept, gone = filters.filter_short(comments(spark, d), ("the",), "comment_raw")
    return kept.select("comment_id", F.lit(True).alias("kept")).union(gone.select("comment_id", F.lit(False)))


_FIRST = f"""WITH {s_first_clean()},
    w AS (SELECT *, {s_words('raw')} AS long, {s_words('text')} AS n, contains(text, '///') OR contains(text, '3/') OR contains(text, 'the') OR contains(text, 'is') AS special FROM clean),
    t AS (SELECT *, CASE WHEN long > 300 THEN 'Comment longer than 300 words' WHEN n <= 3 AND NOT special
        THEN CASE n WHEN 0 THEN 'Empty comment after cleaning' WHEN 1 THEN 'Single word comment' WHEN 2 THEN 'Two words comment' ELSE 'Three words comment' END END AS reason,
        contains(text, 'tion') OR contains(text, 'ing') AS pri FROM w),
    k AS (SELECT *, row_number() OVER (PARTITION BY source, pri ORDER BY doc_id) AS rk, count(*) OVER (PARTITION BY source) AS m, count(*) FILTER (WHERE pri) OVER (PARTITION BY source) AS p FROM t WHERE reason IS NULL),
    f AS (SELECT *, m <= 20 OR pri OR rk <= greatest(0, 20 - p) AS within FROM k)"""


@query(f"""{_FIRST} SELECT reason AS removal_reason, count(*) AS n FROM (SELECT reason FROM t WHERE reason IS NOT NULL UNION ALL
    SELECT 'Balanced - exceeded max 20 comments per post' FROM f WHERE NOT within) GROUP BY reason""")
def removed_union(spark, d):
    kept, gone = curate.first_stage(comments(spark, d), SAMPLE, [F.col("comment_id")], cap=20)
    return gone.groupBy("removal_reason").agg(F.count("*").alias("n"))


@query(f"{_FIRST} SELECT doc_id AS comment_id, source AS post_id, text AS comment_raw, lang AS platform FROM f WHERE within")
def first_stage_kept(spark, d):
    kept, _ = curate.first_stage(comments(spark, d), SAMPLE, [F.col("comment_id")], cap=20)
    return kept


@query(f"SELECT count(*) AS before, count(*) FILTER (WHERE {s_words('text')} <= 300) AS after, count(*) FILTER (WHERE {s_words('text')} > 300) AS removed, round(count(*) FILTER (WHERE {s_words('text')} <= 300) * 100.0::DOUBLE / count(*), 9) AS retained_percent FROM documents")
def retention(spark, d):
    rows = comments(spark, d)
    return report.retention(rows, filters.filter_long(rows)[0]).withColumn("retained_percent", F.round("retained_percent", 9))


@query(f"WITH w AS (SELECT {s_words('text')} AS n FROM documents) SELECT count(*) AS n, min(n)::INT AS least, max(n)::INT AS most, round(avg(n), 6) AS mean, median(n) AS median FROM w")
def long_stats(spark, d):
    return report.word_stats(comments(spark, d), "comment_raw").withColumn("mean", F.round("mean", 6))


@query(f"SELECT doc_id AS comment_id, {s_words('text')} AS n FROM documents ORDER BY n DESC, doc_id LIMIT 3")
def top3_longest(spark, d):
    n = T.count_words(F.col("comment_raw"))
    return groups.top(comments(spark, d).select("comment_id", n.alias("n")), [F.desc("n"), F.col("comment_id")])


@query("SELECT source AS post_id, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def source_counts(spark, d):
    return report.value_counts(comments(spark, d), "post_id")


@query("""
    WITH c AS (SELECT count(*) AS n FROM documents GROUP BY source), b(place, bucket, lo, hi) AS (VALUES (0, '1-10', 1, 10), (1, '11-50', 11, 50), (2, '51-100', 51, 100), (3, '101-500', 101, 500), (4, '501-1000', 501, 1000), (5, '>1000', 1001, 1000000000))
    SELECT place, bucket, (SELECT count(*) FROM c WHERE n BETWEEN lo AND hi) AS groups FROM b""")
def source_histogram(spark, d):
    return report.histogram(comments(spark, d), "post_id")


@query("WITH c AS (SELECT count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source) SELECT count(*) AS groups, avg(n) AS mean, max(n) AS most, min(n) AS least, median(n) AS median FROM c")
def post_stats(spark, d):
    return report.group_stats(comments(spark, d), "post_id")


@query("SELECT count(DISTINCT text) AS texts, count(DISTINCT source) AS ids, count(DISTINCT text) = count(DISTINCT source) AS same FROM documents")
def consistency(spark, d):
    return report.consistency(comments(spark, d), "comment_raw", "post_id")


@query("SELECT count(*) AS n, count(*) - count(DISTINCT text) AS duplicates FROM documents")
def duplicate_count(spark, d):
    return report.duplicates(read(spark, d, "documents"), "text")


@query(f"SELECT count(*) FILTER (WHERE text <> {s_collapse('text')}) AS changed FROM documents")
def changed_rows(spark, d):
    rows = read(spark, d, "documents")
    return report.changed(rows, F.col("text"), T.collapse(F.col("text")))


@query("SELECT name, type, non_null, (SELECT count(*) FROM documents) AS rows FROM (VALUES ('doc_id', 'bigint', (SELECT count(doc_id) FROM documents)), ('text', 'string', (SELECT count(text) FROM documents)), ('lang', 'string', (SELECT count(lang) FROM documents)), ('source', 'string', (SELECT count(source) FROM documents)), ('n_chars', 'bigint', (SELECT count(n_chars) FROM documents))) AS t(name, type, non_null)")
def frame_profile(spark, d):
    return report.profile(read(spark, d, "documents"))


@query(r"SELECT count(*) FILTER (WHERE regexp_matches(text, '(?i)(https?://\S+)|(www\.\S+)|(\S+\.(com|org|net|edu|gov|io|co|tv|me|ly|be|gl)\S*)')) AS with_url, count(*) FILTER (WHERE trim(text) = '') AS blank FROM documents")
def filter_counters(spark, d):
    c = F.col("text")
    return report.reasons(read(spark, d, "documents"), with_url=T.has_url(c), blank=~filters.not_blank(c))


# --- groups ---------------------------------------------------------------------------------------


@query("""
    SELECT doc_id AS comment_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rk FROM documents) WHERE rk <= 20""")
def cap_per_source(spark, d):
    return groups.cap_per_group(comments(spark, d), "post_id", [F.col("comment_id")], 20).select("comment_id")


@query("""
    WITH r AS (SELECT doc_id, source, contains(lower(text), 'trash') OR contains(lower(text), 'idiot') AS pri FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY source, pri ORDER BY doc_id) AS rk, count(*) OVER (PARTITION BY source) AS n, count(*) FILTER (WHERE pri) OVER (PARTITION BY source) AS p FROM r)
    SELECT doc_id AS comment_id FROM k WHERE n <= 20 OR (pri AND rk <= least(p, 3)) OR (NOT pri AND rk <= greatest(0, 20 - least(p, 3)))""")
def cap_two_strata(spark, d):
    pri = T.contains_any(F.col("comment_raw"), ("trash", "idiot"))
    return groups.cap_per_group(comments(spark, d), "post_id", [F.col("comment_id")], 20, pri, 3).select("comment_id")


@query("SELECT source AS post_id, least(count(*), 5) AS n FROM documents GROUP BY source")
def sample_per_group(spark, d):
    return groups.sample_per_group(comments(spark, d), "post_id", 5, "comment_id").groupBy("post_id").agg(F.count("*").alias("n"))


@query("SELECT least(count(*), 30) AS n FROM documents")
def demo_sample(spark, d):
    return groups.sample(comments(spark, d), 30, "comment_id").agg(F.count("*").alias("n"))


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def keep_first(spark, d):
    return groups.keep_first(read(spark, d, "documents"), "text", [F.col("doc_id")]).select("doc_id", "text")


@query("SELECT doc_id AS comment_id, source AS post_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS seq, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7 AS batch FROM documents")
def batch_chunks(spark, d):
    rows = groups.sequence(comments(spark, d), "post_id", [F.col("comment_id")])
    return groups.chunks(rows, "post_id", [F.col("comment_id")], 7).select("comment_id", "post_id", "seq", "batch")


@query("SELECT text AS comment_raw, min(doc_id) AS first_seen FROM documents WHERE text IS NOT NULL GROUP BY text")
def distinct_posts(spark, d):
    return groups.distinct_first_seen(comments(spark, d), "comment_raw", "comment_id")


@query("SELECT doc_id AS comment_id, count(*) OVER (PARTITION BY source) AS group_size FROM documents")
def group_sizes(spark, d):
    return groups.group_size(comments(spark, d), "post_id").select("comment_id", "group_size")


# --- summaries ------------------------------------------------------------------------------------


def _threads(spark, d):
    rows = read(spark, d, "conversations")
    posts = rows.where("turn = 0").select("conv_id", F.col("text").alias("post_raw"))
    return rows.where("turn > 0").join(posts, "conv_id", "left").select("conv_id", "turn", "post_raw", F.col("text").alias("comment_raw"), F.col("role").alias("author"))


@query(f"""
    WITH p AS (SELECT conv_id, text AS post_raw FROM conversations WHERE turn = 0)
    SELECT c.conv_id, c.turn, CASE WHEN p.post_raw IS NULL THEN NULL ELSE array_to_string(list_filter(regexp_split_to_array(p.post_raw, '{S}+'), lambda w: w <> '')[1:8], ' ') END AS summary
    FROM conversations c LEFT JOIN p USING (conv_id) WHERE c.turn > 0""")
def summary_join_back(spark, d):
    rows = _threads(spark, d)
    return summarize.join_back(rows, summarize.map_distinct(rows, "post_raw")).select("conv_id", "turn", "summary")


def _summary_client():
    """Answers in a fence, without quotes around names, and in reverse order."""
    item = lambda x: f'{{id: "{x["id"]}", summary: "n{len(x["text"])}"}}'
    return lambda prompt: f"```json\n{{results: [{', '.join(map(item, reversed(json.loads(prompt))))}]}}\n```"


@query("""
    WITH p AS (SELECT conv_id, text AS post_raw FROM conversations WHERE turn = 0)
    SELECT c.conv_id, c.turn, 'n' || length(p.post_raw) AS summary FROM conversations c LEFT JOIN p USING (conv_id) WHERE c.turn > 0""")
def summarise_plan(spark, d):
    return models.summarise(_threads(spark, d), _summary_client, budget=1 << 40).select("conv_id", "turn", "summary")


@query("SELECT 'post_' || (doc_id + 1) AS post_id, doc_id AS comment_id, text AS comment_raw, '01-02-2024' AS created_date, CASE WHEN doc_id % 2 = 0 THEN 'youtube' ELSE 'Unknown' END AS platform FROM documents")
def backfill_columns(spark, d):
    rows = comments(spark, d).drop("post_id", "platform")
    name = F.when(F.col("comment_id") % 2 == 0, "v1_YouTube_2.csv").otherwise("x.csv")
    return summarize.ordered(summarize.backfill(rows, "comment_id", name, "01-02-2024"))


@query("SELECT 'Original:' || chr(10) || text || chr(10) || 'Summary:' || chr(10) || lang || chr(10) AS value FROM documents")
def text_report(spark, d):
    return summarize.report_lines(read(spark, d, "documents").select(F.col("text").alias("post_raw"), F.col("lang").alias("summary")))


# --- JSON -----------------------------------------------------------------------------------------


def _responses(spark, d):
    return read(spark, d, "labels").select("doc_id", F.format_string('Here: ```json\n{"results": [{"id": "id%d", "summary": "q%d t%d"}]}\n``` done', "doc_id", "quality", "toxic").alias("response"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN toxic = 1 THEN 'FIRST' ELSE 'NEUTRAL' END AS label FROM labels")
def json_labels_parse(spark, d):
    body = F.to_json(F.create_map(F.col("doc_id").cast("string"), F.when(F.col("toxic") == 1, "FIRST").otherwise("NEUTRAL")))
    return label.exploded_labels(read(spark, d, "labels").select(body.alias("response")))


@query("SELECT doc_id, 'id' || doc_id AS id, 'q' || quality || ' t' || toxic AS summary FROM labels")
def json_response_explode(spark, d):
    return _responses(spark, d).select("doc_id", F.explode(jsontext.strict_results(F.col("response"))).alias("x")).select("doc_id", "x.*")


@query("SELECT doc_id, 'id' || doc_id AS id, 'q' || quality || ' t' || toxic AS summary FROM labels")
def json_repair(spark, d):
    broken = F.regexp_replace("response", F.lit(r'"\}\]\}\n``` done'), F.lit(""))  # unterminated
    return _responses(spark, d).select("doc_id", F.explode(jsontext.results(broken)).alias("x")).select("doc_id", "x.*")


# --- labels ---------------------------------------------------------------------------------------

_A = r"regexp_matches(lower(text), '\b(idiot|moron|stupid)\b') OR regexp_matches(lower(text), '\b(trash|scum)\b')"
_B = r"regexp_matches(lower(text), '\b(worthless|pathetic)\b') OR regexp_matches(lower(text), '\b(clown)\b')"
_STRONG = "contains(lower(text), 'idiot') OR contains(lower(text), 'moron') OR contains(lower(text), 'trash')"
_CASCADE = f"CASE WHEN {_A} THEN 'FIRST' WHEN {_B} THEN 'SECOND' ELSE 'NEUTRAL' END"
_FIXED = f"CASE WHEN ({_CASCADE}) = 'FIRST' AND contains(lower(text), 'the') AND NOT ({_STRONG}) THEN 'NEUTRAL' ELSE ({_CASCADE}) END"


@query(f"SELECT doc_id AS comment_id, {_CASCADE} AS label FROM documents")
def rule_cascade(spark, d):
    return comments(spark, d).select("comment_id", label.cascade(F.lit(SAMPLE.neutral), F.col("comment_raw"), SAMPLE).alias("label"))


@query(f"SELECT doc_id AS comment_id, {_FIXED} AS label FROM documents")
def false_positive_fix(spark, d):
    return label.label_comments(comments(spark, d), SAMPLE).select("comment_id", "label")


@query("SELECT doc_id AS comment_id, CASE WHEN toxic = 1 THEN 'FIRST' ELSE 'NEUTRAL' END AS label FROM documents LEFT JOIN labels USING (doc_id)")
def label_fill_default(spark, d):
    said = read(spark, d, "labels").select(F.col("doc_id").alias("comment_id"), F.when(F.col("toxic") == 1, "FIRST").otherwise("odd").alias("said"))
    return comments(spark, d).join(said, "comment_id", "left").select("comment_id", label.fill(F.col("said"), SAMPLE).alias("label"))


@query("WITH s AS (SELECT source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 50 AS batch FROM documents) SELECT source AS summary, batch, count(*) AS n FROM s GROUP BY ALL")
def label_batches(spark, d):
    rows = label.label_batches(comments(spark, d).withColumn("summary", F.col("post_id")), [F.col("comment_id")])
    return rows.select("summary", "batch", F.size("ids").cast("long").alias("n"))


def _label_client():
    def answer(prompt: str) -> str:
        ids = [int(x) for x in json.loads(prompt)]
        return json.dumps({str(i): ("FIRST", "odd", "SECOND")[min(i % 7, 2)] for i in ids} | {"-1": "FIRST"})

    return answer


@query(f"""
    WITH s AS (SELECT *, CASE doc_id % 7 WHEN 0 THEN 'FIRST' WHEN 1 THEN 'NEUTRAL' ELSE 'SECOND' END AS said FROM documents),
    c AS (SELECT *, CASE WHEN {_A} THEN 'FIRST' WHEN {_B} THEN 'SECOND' ELSE said END AS ruled FROM s)
    SELECT doc_id AS comment_id, CASE WHEN source IS NULL THEN '' WHEN ruled = 'FIRST' AND contains(lower(text), 'the') AND NOT ({_STRONG}) THEN 'NEUTRAL' ELSE ruled END AS label FROM c""")
def label_plan(spark, d):
    rows = comments(spark, d).withColumn("summary", F.col("post_id"))
    return models.label_all(rows, SAMPLE, _label_client, [F.col("comment_id")], template="{comments}").select("comment_id", "label")


_OTHER = "CASE WHEN toxic = 1 THEN 'FIRST' WHEN quality = 0 THEN 'SECOND' ELSE 'NEUTRAL' END"


def _compared(spark, d):
    own = labelled(spark, d)
    return label.compare(label.label_comments(own, SAMPLE), own, "comment_id")


@query(f"SELECT doc_id AS comment_id, {_FIXED} AS model1_label, {_OTHER} AS model2_label, ({_FIXED}) = ({_OTHER}) AS same FROM documents JOIN labels USING (doc_id)")
def model_compare(spark, d):
    return _compared(spark, d).select("comment_id", "model1_label", "model2_label", "same")


@query(f"WITH x AS (SELECT ({_FIXED}) = ({_OTHER}) AS same FROM documents JOIN labels USING (doc_id)) SELECT count(*) AS total, count(*) FILTER (WHERE same) AS matches, count(*) FILTER (WHERE NOT same) AS differences, round(count(*) FILTER (WHERE same) * 100.0::DOUBLE / count(*), 9) AS accuracy FROM x")
def agreement(spark, d):
    return label.agreement(_compared(spark, d)).withColumn("accuracy", F.round("accuracy", 9))


@query(f"WITH x AS (SELECT 1 AS m, {_FIXED} AS label FROM documents JOIN labels USING (doc_id) UNION ALL SELECT 2, {_OTHER} FROM documents JOIN labels USING (doc_id)) SELECT label, count(*) FILTER (WHERE m = 1) AS model1, count(*) FILTER (WHERE m = 2) AS model2 FROM x GROUP BY label")
def model_distribution(spark, d):
    return label.distributions(_compared(spark, d))


@query(f"""
    WITH a AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS index, {_FIXED} AS model1_label FROM documents JOIN labels USING (doc_id)),
    b AS (SELECT row_number() OVER (ORDER BY doc_id DESC) - 1 AS index, {_OTHER} AS model2_label FROM labels)
    SELECT index, model1_label, model2_label, model1_label = model2_label AS same FROM a JOIN b USING (index)""")
def position_compare(spark, d):
    own = labelled(spark, d)
    ruled = label.label_comments(own, SAMPLE)
    return label.compare_by_position(ruled, own, [F.col("comment_id")], [F.col("comment_id").desc()]).select("index", "model1_label", "model2_label", "same")


@query(f"""
    WITH x AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS index, text, {_FIXED} AS model1_label, {_OTHER} AS model2_label FROM documents JOIN labels USING (doc_id))
    SELECT index, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS comment, model1_label, model2_label FROM x WHERE model1_label <> model2_label ORDER BY index LIMIT 20""")
def first_differences(spark, d):
    own = labelled(spark, d)
    compared = label.compare_by_position(label.label_comments(own, SAMPLE), own, [F.col("comment_id")], [F.col("comment_id")])
    return label.differences(compared, 20).select("index", F.col("comment_text").alias("comment"), "model1_label", "model2_label")


@query("SELECT doc_id AS comment_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch FROM documents")
def global_batches(spark, d):
    return places.chunks(comments(spark, d), [F.col("comment_id")], 50).select("comment_id", "batch")


@query("SELECT doc_id AS comment_id, (coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS chars_before FROM documents")
def chars_before(spark, d):
    return places.running(comments(spark, d), [F.col("comment_id")], "post_id", F.length("comment_raw"), "chars_before").select("comment_id", "chars_before")


# --- capacity and quotas --------------------------------------------------------------------------


@query("WITH s AS (SELECT count(*) AS n FROM documents GROUP BY source) SELECT CAST(sum(ceil(n / 50.0)) AS BIGINT) AS batches FROM s")
def batch_estimate(spark, d):
    return capacity.batches(comments(spark, d).withColumnRenamed("post_id", "summary"), 50)


@query("""
    WITH s AS (SELECT count(*) AS n FROM documents GROUP BY source), b AS (SELECT CAST(sum(ceil(n / 50.0)) AS BIGINT) AS batches FROM s)
    SELECT (SELECT count(*) FROM documents) AS total_comments, batches AS estimated_batches, 50 AS adjusted_batch_size, 20 AS total_rpm_capacity, 500000 AS total_tpm_capacity, 500 AS total_rpd_capacity,
           18 AS effective_rpm, round(batches / 18.0::DOUBLE, 9) AS estimated_minutes, round(batches / 18.0::DOUBLE / 60 * 1.1, 9) AS estimated_hours, batches <= 500 AS is_feasible FROM b""")
def model_capacity(spark, d):
    out = capacity.capacity(comments(spark, d).withColumnRenamed("post_id", "summary"), "gemini-2.5-flash", 2).drop("capacity_issues", "recommendations")
    return out.withColumns({c: F.round(c, 9) for c in ("estimated_minutes", "estimated_hours")})


@query("""
    WITH s AS (SELECT count(*) AS n FROM documents GROUP BY source), b AS (SELECT CAST(sum(ceil(n / 95.0)) AS BIGINT) AS batches FROM s)
    SELECT (SELECT count(*) FROM documents) AS total_comments, batches AS estimated_batches, 95 AS adjusted_batch_size, 3 AS total_rpm_capacity, 10000 AS total_tpm_capacity, 15 AS total_rpd_capacity,
           2 AS effective_rpm, round(batches / 2.0::DOUBLE, 9) AS estimated_minutes, round(batches / 2.0::DOUBLE / 60 * 1.1, 9) AS estimated_hours, false AS is_feasible,
           'RPD limit: ' || batches || ' > 15' AS capacity_issues, 'Split processing across multiple days' AS recommendations FROM b""")
def model_capacity_tight(spark, d):
    """A batch size that the tokens of a minute don't allow is cut down; too few requests a day are said."""
    out = capacity.capacity(comments(spark, d).withColumnRenamed("post_id", "summary"), "gemini-2.5-flash-preview-tts", 1, 500)
    return out.withColumns({c: F.round(c, 9) for c in ("estimated_minutes", "estimated_hours")} | {c: F.array_join(c, "; ") for c in ("capacity_issues", "recommendations")})


@query(f"""
    WITH s AS (SELECT count(*) AS n FROM documents GROUP BY source), b AS (SELECT CAST(sum(ceil(n / 50.0)) AS BIGINT) AS batches FROM s), m(model, rpm, rpd, tpm) AS (VALUES {", ".join(map(str, QUOTAS))})
    SELECT model, batches, round(greatest(0.1, batches / (rpm * 2)::DOUBLE / 60), 9) AS hours, rpm * 2 >= 10 AND tpm * 2 >= 100000 AND batches <= rpd * 2 AS feasible FROM b, m""")
def model_feasibility(spark, d):
    return capacity.feasibility(comments(spark, d).withColumnRenamed("post_id", "summary"), 2).withColumn("hours", F.round("hours", 9))


def _requests(spark, d):
    return read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("key"), "ts")


@query("""
    WITH q AS (SELECT event_id AS id, row_number() OVER (PARTITION BY user_id, date_trunc('minute', ts) ORDER BY ts, event_id) AS in_minute, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS in_day FROM events)
    SELECT id, in_minute, in_day, in_minute <= 1 AND in_day <= 2 AS admitted FROM q""")
def quota_minute_day(spark, d):
    return capacity.quota_windows(_requests(spark, d), 1, 2).select("id", "in_minute", "in_day", "admitted")


@query("""
    WITH g AS (SELECT *, coalesce(CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 3600000000 THEN 1 ELSE 0 END, 0) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS burst FROM g)
    SELECT event_id AS id, CAST(burst AS BIGINT) AS burst, row_number() OVER (PARTITION BY user_id, burst ORDER BY ts, event_id) AS in_burst FROM b""")
def quota_gaps(spark, d):
    return capacity.quota_gaps(_requests(spark, d), 2, gap_s=3600).select("id", "burst", "in_burst")


_SLOTS = """
    c AS (SELECT doc_id, greatest(1, length(text) // 4) AS tokens, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
    k AS (SELECT *, (i % 3)::INT AS key_no, (i // 3) // 100 AS day, (i // 3) % 100 AS j FROM c),
    s AS (SELECT doc_id, tokens, key_no, day, j, 0::BIGINT AS minute, 1::BIGINT AS calls, tokens AS held FROM k WHERE j = 0
          UNION ALL
          SELECT k.doc_id, k.tokens, k.key_no, k.day, k.j, CASE WHEN calls = 5 OR held + k.tokens > 4000 THEN minute + 1 ELSE minute END,
                 CASE WHEN calls = 5 OR held + k.tokens > 4000 THEN 1 ELSE calls + 1 END, CASE WHEN calls = 5 OR held + k.tokens > 4000 THEN k.tokens ELSE held + k.tokens END
          FROM s JOIN k ON k.key_no = s.key_no AND k.day = s.day AND k.j = s.j + 1),
    u AS (SELECT key_no, day, (max(minute) + 1440) // 1440 AS days FROM s GROUP BY key_no, day),
    f AS (SELECT key_no, day, coalesce(sum(days) OVER (PARTITION BY key_no ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM u),
    t AS (SELECT doc_id, tokens, key_no, (first * 1440 + minute)::BIGINT AS slot, calls - 1 AS in_slot FROM s JOIN f USING (key_no, day))"""


def _scheduled(spark, d):
    calls = comments(spark, d).withColumn("tokens", F.greatest(F.lit(1), T.token_estimate(F.col("comment_raw"))))
    return schedule.schedule(calls, 3, schedule.Quota(5, 4000, 100), [F.col("comment_id")], F.col("tokens"))


@query(f"WITH RECURSIVE {_SLOTS} SELECT doc_id AS comment_id, key_no, slot, in_slot, tokens > 4000 AS over_tokens FROM t")
def call_schedule(spark, d):
    return _scheduled(spark, d).select("comment_id", "key_no", "slot", "in_slot", "over_tokens")


@query(f"WITH RECURSIVE {_SLOTS} SELECT key_no, slot, count(*) AS calls, sum(tokens)::BIGINT AS tokens, count(*) <= 5 AND (sum(tokens) <= 4000 OR count(*) = 1) AS within FROM t GROUP BY key_no, slot")
def call_usage(spark, d):
    used = schedule.usage(_scheduled(spark, d), F.col("tokens"))
    return used.withColumn("within", (F.col("calls") <= 5) & ((F.col("tokens") <= 4000) | (F.col("calls") == 1)))


@query("""
    WITH s AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 50 AS batch FROM documents)
    SELECT source AS summary, min(doc_id)::VARCHAR AS first_id, count(*)::INT AS comments, 'labels for ' || count(*) AS response FROM s GROUP BY source, batch""")
def resumed_labels(spark, d):
    """A run over the calls of some posts, then one over all: it makes the other calls only."""
    rows = comments(spark, d).withColumn("summary", F.col("post_id"))
    book = ledger.Ledger(spark, f"{tables.shared_dir(spark)}/ledger-{uuid.uuid4().hex}")
    client = lambda: lambda prompt: f"labels for {len(json.loads(prompt))}"
    book.run(models.label_calls(rows.where(F.crc32("post_id") % 3 == 0), [F.col("comment_id")], template="{comments}"), client)
    said = book.run(models.label_calls(rows, [F.col("comment_id")], template="{comments}"), client)
    owner = rows.select(F.col("comment_id").cast("string").alias("_id"), "summary")
    number = F.transform("ids", lambda x: x.cast("long"))
    return said.withColumn("first_id", F.array_min(number).cast("string")).join(owner, F.col("first_id") == F.col("_id")).select("summary", "first_id", F.size("ids").alias("comments"), "response")


# --- audit ----------------------------------------------------------------------------------------


def _audited(spark, d):
    rows = comments(spark, d).join(read(spark, d, "labels").select(F.col("doc_id").alias("comment_id"), F.col("toxic").alias("label")), "comment_id", "left")
    return audit.prepare(rows, {0: "NEUTRAL", 1: "FIRST"}, "SECOND")


_BASE = "SELECT doc_id AS comment_id, source, text, lang, CASE toxic WHEN 0 THEN 'NEUTRAL' WHEN 1 THEN 'FIRST' ELSE 'SECOND' END AS label FROM documents LEFT JOIN labels USING (doc_id)"


def _edits(spark, d):
    own = read(spark, d, "documents").select("doc_id")
    x = own.where("doc_id % 10 = 0").select(F.col("doc_id").alias("comment_id"), F.lit("label").alias("action"), F.lit("EDITED").alias("value"), F.lit(1).alias("seq"))
    y = own.where("doc_id % 15 = 0").select(F.col("doc_id").alias("comment_id"), F.lit("flag"), F.lit(None).cast("string"), F.lit(2))
    z = own.where("doc_id % 25 = 0").select(F.col("doc_id").alias("comment_id"), F.lit("toggle"), F.lit(None).cast("string"), F.lit(3))
    return x.union(y).union(z)


@query(f"SELECT comment_id, CASE WHEN comment_id % 10 = 0 THEN 'EDITED' ELSE label END AS label, (comment_id % 15 = 0) <> (comment_id % 25 = 0) AS delete_flag FROM ({_BASE})")
def audit_apply_edits(spark, d):
    return audit.apply_edits(_audited(spark, d), _edits(spark, d), "comment_id").select("comment_id", "label", "delete_flag")


@query(f"SELECT comment_id, source IN (SELECT source FROM documents WHERE doc_id < 3) AS delete_flag FROM ({_BASE})")
def audit_flag_post(spark, d):
    rows = _audited(spark, d)
    return audit.flag_post(rows, rows.where("comment_id < 3"), "post_id").select("comment_id", "delete_flag")


@query(f"SELECT comment_id FROM ({_BASE}) WHERE label = 'FIRST' AND contains(lower(text), 'idiot')")
def audit_filter_search(spark, d):
    return audit.view(_audited(spark, d), label="FIRST", query="Idiot").select("comment_id")


@query(f"SELECT comment_id FROM ({_BASE}) WHERE {s_tokens('text')} < 5")
def audit_short_view(spark, d):
    return audit.view(_audited(spark, d), short=True).select("comment_id")


@query(f"SELECT comment_id, text AS comment, label, '' AS mark, lang AS platform, {s_tokens('text')}::INT AS words, label AS style FROM ({_BASE})")
def audit_display(spark, d):
    return audit.display(_audited(spark, d), "comment_id")


@query("SELECT doc_id AS comment_id, source AS post_id, text AS comment_raw FROM documents WHERE doc_id IN (7, 77, 777, -1)")
def row_details(spark, d):
    """Rows looked up by their keys in a table sorted by it: the files that hold them are read."""
    path = tables.write_sorted(comments(spark, d), f"{tables.shared_dir(spark)}/sorted-{uuid.uuid4().hex}", "comment_id", 100)
    return tables.lookup(spark, path, "comment_id", [7, 77, 777, -1]).select("comment_id", "post_id", "comment_raw")


@query(f"SELECT source AS post_id, comment_id, text AS comment_raw, lang AS platform, CASE WHEN comment_id % 10 = 0 THEN 'EDITED' ELSE label END AS label FROM ({_BASE}) WHERE NOT ((comment_id % 15 = 0) <> (comment_id % 25 = 0))")
def audit_export(spark, d):
    return audit.export(audit.apply_edits(_audited(spark, d), _edits(spark, d), "comment_id"))


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE label = 'NEUTRAL') AS n_0, count(*) FILTER (WHERE label = 'FIRST') AS n_1, count(*) FILTER (WHERE label = 'SECOND') AS n_2, 0 AS flagged FROM ({_BASE})")
def audit_stats(spark, d):
    return audit.stats(_audited(spark, d), SAMPLE.labels)


# --- pages and dates ------------------------------------------------------------------------------


@query(r"""SELECT page_id, unnest(regexp_extract_all(html, '(?i)href\s*=\s*"([^"]*)"', 1)) AS link FROM pages""")
def html_links(spark, d):
    return read(spark, d, "pages").select("page_id", F.explode(html.links(F.col("html"))).alias("link"))


@query(rf"""SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1), lambda p: {s_collapse("regexp_replace(p, '<[^>]+>', ' ', 'g')")}), lambda p: p <> ''), ' ') AS body FROM pages""")
def html_paragraphs(spark, d):
    return read(spark, d, "pages").select("page_id", html.joined_paragraphs(F.col("html")).alias("body"))


@query()
def html_elements(spark, d):
    return html.elements(read(spark, d, "pages"), "page_id", "a", "href", "").select("page_id", "n", "text", "value")


@query(r"SELECT page_id, regexp_extract(url, '([^/?#]+)/?(?:[?#].*)?$', 1) AS post FROM pages")
def url_post_id(spark, d):
    return read(spark, d, "pages").select("page_id", html.post_id(F.col("url"), F.lit("tiktok")).alias("post"))


@query(r"""
    WITH p AS (SELECT page_id, page_id % 5 AS k, CASE page_id % 5 WHEN 0 THEN url || '/groups/permalink/' || page_id || '/' WHEN 1 THEN url || '/video/v' || page_id || '?x=1' WHEN 2 THEN url || '?a=b&v=id' || page_id || '&t=1#c'
               WHEN 3 THEN url || '/comments/c' || page_id || '/title' ELSE url || '/post/P' || page_id || '?q' END AS link FROM pages)
    SELECT page_id, CASE k WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 1 THEN regexp_extract(link, '([^/?#]+)/?(?:[?#].*)?$', 1) WHEN 2 THEN regexp_extract(link, '[?&]v=([^&#]*)', 1)
           WHEN 3 THEN regexp_extract(link, '/comments/([^/?#]+)', 1) ELSE regexp_extract(link, '/post/([^/?#]+)', 1) END AS post FROM p""")
def platform_post_ids(spark, d):
    """All five rules, each on URLs of its kind made from the table's."""
    n, k = F.col("page_id").cast("string"), F.col("page_id") % 5
    tails = [F.concat(F.lit("/groups/permalink/"), n, F.lit("/")), F.concat(F.lit("/video/v"), n, F.lit("?x=1")), F.concat(F.lit("?a=b&v=id"), n, F.lit("&t=1#c")), F.concat(F.lit("/comments/c"), n, F.lit("/title")), F.concat(F.lit("/post/P"), n, F.lit("?q"))]
    pick = lambda own: F.element_at(F.array(*own), (k + 1).cast("int"))
    platform = pick([F.lit(x) for x in ("facebook", "tiktok", "youtube", "reddit", "threads")])
    return read(spark, d, "pages").select("page_id", html.post_id(F.concat("url", pick(tails)), platform).alias("post"))


@query("""
    WITH t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
    SELECT conv_id, turn, conv_id || '_' || k AS comment_id FROM t""")
def numbered_comments(spark, d):
    return html.numbered_comments(read(spark, d, "conversations"), "conv_id", "turn").select("conv_id", "turn", "comment_id")


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(TIMESTAMP '2024-03-31 17:00:00' - to_days(CAST(event_id % 40 AS INT)), '%d-%m-%Y') WHEN 1 THEN strftime(TIMESTAMP '2024-03-31 17:00:00' - to_weeks(CAST(event_id % 40 AS INT)), '%d-%m-%Y') WHEN 2 THEN strftime(TIMESTAMP '2024-03-31 17:00:00' - to_hours(event_id % 40), '%d-%m-%Y') WHEN 3 THEN strftime(TIMESTAMP '2024-03-31 17:00:00' - to_minutes(event_id % 40), '%d-%m-%Y') ELSE 'yesterday' END AS day FROM events")
def relative_dates(spark, d):
    n = (F.col("event_id") % 40).cast("string")
    k = F.col("event_id") % 5
    raw = F.when(k == 0, F.concat(n, F.lit("d"))).when(k == 1, F.concat(n, F.lit("w"))).when(k == 2, F.concat(n, F.lit("h"))).when(k == 3, F.concat(n, F.lit("m"))).otherwise("yesterday")
    return read(spark, d, "events").select("event_id", dates.short_relative(raw, F.expr(NOW)).alias("day"))


@query("SELECT event_id, strftime(TIMESTAMP '2024-03-31 17:00:00' - to_seconds(event_id % 40), '%d-%m-%Y') AS loose, strftime(TIMESTAMP '2024-03-31 17:00:00' - to_days(CAST(event_id % 40 AS INT)), '%d-%m-%Y') AS exact, strftime(TIMESTAMP '2024-03-31 10:00:00' - to_months(CAST(event_id % 40 AS INT)), '%d-%m-%Y') AS months FROM events")
def ago_dates(spark, d):
    n, now = (F.col("event_id") % 40).cast("string"), F.expr(NOW)
    raw = F.concat(n, F.lit(" days ago"))
    return read(spark, d, "events").select("event_id", dates.ago(raw, now).alias("loose"), dates.ago(raw, now, exact=True).alias("exact"), dates.vietnamese(F.concat(n, F.lit(" tháng trước")), now).alias("months"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'no date' ELSE strftime(ts, '%d-%m-%Y') END AS day FROM events")
def iso_dates(spark, d):
    raw = F.when(F.col("event_id") % 7 == 0, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return read(spark, d, "events").select("event_id", dates.iso(raw).alias("day"))
