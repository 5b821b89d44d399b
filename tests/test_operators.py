"""Relational operators, sources, sinks, plans and streams on small frames."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidemill import rules
from tidemill.functions import text as T
from tidemill.operators import audit, capacity, filters, groups, label, report, summarize
from tidemill.plans import curate
from tidemill.sources import html, readers, writers
from tidemill.streaming import streams


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(i, f"p{g}", f"{'VIP ' if i % 4 == 0 else ''}word number {i} of this post", g) for g, n in ((0, 3), (1, 10), (2, 25)) for i in range(g * 100, g * 100 + n)]
    rows += [(900, None, "no post here at all", 9)]
    return spark.createDataFrame(rows, "comment_id long, post_id string, comment_raw string, g int")


@pytest.mark.parametrize("quota", [None, 2])
def test_cap(posts, quota):
    pri = T.contains_any(F.col("comment_raw"), ("vip",))
    kept = groups.cap_per_group(posts, "post_id", groups.hashed("comment_id"), 10, pri, quota)
    n = {r.post_id: (r.n, r.p) for r in kept.groupBy("post_id").agg(F.count("*").alias("n"), F.count_if(pri).alias("p")).collect()}
    assert n["p0"][0] == 3 and n["p1"][0] == 10 and None not in n
    assert n["p2"] == (10, 7 if quota is None else 2)
    whole = groups.cap_per_group(posts, "post_id", groups.hashed("comment_id"), 100, pri, quota)
    assert whole.count() == posts.count()
    again = groups.cap_per_group(posts.repartition(1), "post_id", groups.hashed("comment_id"), 10, pri, quota)
    assert sorted(kept.collect()) == sorted(again.collect())


def test_cap_limits_before_the_shuffle(posts):
    plan = groups.cap_per_group(posts, "post_id", [F.col("comment_id")], 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan


def test_samples_and_sequences(posts):
    assert groups.sample_per_group(posts, "post_id", 4, "comment_id").where("post_id = 'p2'").count() == 4
    assert groups.sample(posts, 5, "comment_id").count() == 5
    rows = groups.chunks(posts, "post_id", [F.col("comment_id")], 4).where("post_id = 'p1'").orderBy("comment_id").collect()
    assert [r.batch for r in rows] == [0] * 4 + [1] * 4 + [2] * 2
    assert groups.keep_first(posts, "post_id", [F.col("comment_id")]).count() == 4
    assert groups.distinct_first_seen(posts, "post_id", "comment_id").count() == 3


def test_first_stage_keeps_or_removes_every_row(posts):
    own = rules.RuleSet(priority=("vip",), keep=("xyz",))
    for cap in (None, 10):
        kept, removed = curate.first_stage(posts, own, [F.col("comment_id")], max_words=5, cap=cap)
        lost = 0 if cap is None else 1  # the row without a post, gone once any post is over the cap
        over_words = posts.where(T.count_words(F.col("comment_raw")) > 5).count()
        assert kept.count() + removed.count() == posts.count() - (lost if kept.where("post_id is null").isEmpty() else 0)
        assert removed.where("removal_reason = 'Comment longer than 5 words'").count() == over_words


def test_first_stage_cleans_no_long_text(posts, monkeypatch):
    """Long texts go by their raw words, so their cleaning, most of the work on large texts, is left out."""
    monkeypatch.setattr(T, "minimal_clean", lambda c, normalise: F.when(T.count_words(c) > 5, F.raise_error(F.lit("cleaned"))).otherwise(c))
    rows = posts.limit(3).union(posts.limit(1).selectExpr("777L", "post_id", "repeat('long ', 9)", "g"))
    for cap in (None, 2):
        kept, removed = curate.first_stage(rows.withColumn("comment_raw", F.when(F.col("comment_id") == 777, F.col("comment_raw")).otherwise("four words are here")), rules.RuleSet(), [F.col("comment_id")], max_words=5, cap=cap)
        assert len(kept.collect()) == (cap or 3)
        assert [r.comment_id for r in removed.where("removal_reason like 'Comment longer%'").collect()] == [777]


def test_final_stage(spark):
    rows = spark.createDataFrame([(1, "Hay QUÁ!!!", "a"), (2, "hay quá", "b"), (3, None, "c"), (4, "...", "d"), (5, "", "e")], "comment_id long, comment_raw string, label string")
    got = curate.final_stage(rows, [F.col("comment_id")])
    assert {(r.comment_id, r.comment_clean) for r in got.collect()} == {(1, "hay quá"), (3, None), (4, "")}


def test_filters(spark):
    df = spark.createDataFrame([("a b c d e",), (None,), ("x",), ("///",), ("",)], "comment_clean string")
    kept, gone = filters.filter_short(df, ("///",))
    assert kept.count() == 2 and {r.removal_reason for r in gone.collect()} == {"Empty or invalid comment", "Single word comment", "Empty comment after cleaning"}
    assert [r[0] for r in df.select(filters.short_view(F.col("comment_clean"))).collect()] == [False, True, True, True, True]
    assert df.where(filters.search(F.col("comment_clean"), "B C")).count() == 1 and df.where(filters.search(F.col("comment_clean"), "")).count() == 5
    assert filters.clamp(None, 50) is None and filters.clamp(3, 50) == 50
    with pytest.raises(ValueError, match="nope"):
        filters.require(df, "nope")


def test_summaries(spark):
    rows = spark.createDataFrame([(1, "post one has more than eight words in it"), (2, None), (3, "two"), (4, "two"), (5, "bad")], "comment_id long, post_raw string")

    def make():
        def call(batch):
            if "bad" in batch:
                raise RuntimeError("refused")
            return [x.upper()[:5] for x in batch]

        return call

    said = summarize.map_distinct(rows, "post_raw", make, batch=1)
    got = {r.comment_id: r.summary for r in summarize.join_back(rows, said).collect()}
    assert got == {1: "POST ", 2: None, 3: "TWO", 4: "TWO", 5: ""}
    assert summarize._within(["x" * 40, "y" * 40], lambda b: [str(len(b))] * len(b), 12, 1, 0) == ["1", "1"]
    back = summarize.backfill(rows, "comment_id", F.lit("My_TikTok_file"), "01-01-2024")
    assert {r.platform for r in back.drop("comment_raw").collect()} == {"tiktok"} and "post_2" in {r.post_id for r in back.collect()}
    with pytest.raises(ValueError):
        summarize.ordered(rows.select(F.lit(1).alias("z")))


def test_labels(spark):
    own = rules.RuleSet(neutral="N", first="A", second="B", first_patterns=(r"\b(cs)\b", r"\bđỏ\b"), second_patterns=(r"\bque\b",), doubtful="đài", strong=("csvn",))
    rows = spark.createDataFrame([(1, "CS que"), (2, "ba QUE"), (3, "nghe đài cs"), (4, "đài cs csvn"), (5, None), (6, "ĐỎ"), (7, "xcs")], "comment_id long, comment_raw string")
    model = spark.createDataFrame([(7, "B"), (5, "weird")], "comment_id long, label string")
    got = {r.comment_id: r.label for r in label.label_comments(rows, own, model).collect()}
    assert got == {1: "A", 2: "B", 3: "N", 4: "A", 5: "N", 6: "A", 7: "B"}
    other = rows.withColumn("label", F.lit("A"))
    both = label.compare(label.label_comments(rows, own, model), other, "comment_id")
    assert label.agreement(both).first().matches == 3 and label.compare(rows.limit(2).withColumn("label", F.lit("A")), other, "comment_id") is None
    batch = label.label_batches(rows.withColumn("summary", F.lit("s" * 300)), [F.col("comment_id")], 5)
    assert sorted(len(json.loads(r.comments)) for r in batch.collect()) == [2, 5]
    assert label.demo(rows, lambda d: label.label_comments(d, own), 3, "comment_id").count() == 3


def test_audit(spark):
    rows = audit.prepare(spark.createDataFrame([(1, "p", "x", 1), (2, "p", "y", None), (3, None, "z", 7)], "comment_id long, post_raw string, comment_raw string, label int"), {1: "A"}, "N")
    assert [r.label for r in rows.orderBy("comment_id").collect()] == ["A", "N", "7"]
    edits = spark.createDataFrame([(1, "toggle", None, 1), (1, "flag", None, 2), (1, "toggle", None, 3), (2, "label", "B", 1), (2, "label", "C", 2), (3, "text", "new", 1), (3, "toggle", None, 2)], "comment_id long, action string, value string, seq int")
    got = {r.comment_id: (r.label, r.comment_raw, r.delete_flag) for r in audit.apply_edits(rows, edits, "comment_id").collect()}
    assert got == {1: ("A", "x", False), 2: ("C", "y", False), 3: ("7", "new", True)}
    assert {r.comment_id for r in audit.flag_post(rows, rows.where("comment_id in (1, 3)")).where("delete_flag").collect()} == {1, 2}
    assert audit.export(audit.apply_edits(rows, edits, "comment_id")).count() == 2


def test_capacity(spark):
    rows = spark.createDataFrame([("s",)] * 120 + [(None,)] * 3, "summary string")
    assert capacity.batches(rows, 50).first()[0] == 3 and capacity.batches(rows.withColumnRenamed("summary", "x"), 50).first()[0] == 3
    small = capacity.capacity(rows, "gemini-2.5-flash-preview-tts", 1, size=150).first()
    assert small.adjusted_batch_size == 95 and small.estimated_batches == 2 and not small.is_feasible
    assert capacity.feasibility(rows, 1).count() == 8


def test_quotas(spark):
    t = datetime.datetime(2024, 1, 1, 10, 0)
    rows = [(i, "k", t + datetime.timedelta(seconds=s)) for i, s in enumerate((0, 30, 59, 60, 150, 151))]
    df = spark.createDataFrame(rows, "id long, key string, ts timestamp")
    got = capacity.quota_windows(df, 2, 5).orderBy("id").collect()
    assert [r.admitted for r in got] == [True, True, False, True, True, False]
    assert [r.in_burst for r in capacity.quota_gaps(df, 2).orderBy("id").collect()] == [1, 2, 3, 4, 1, 2]


def test_reports(spark, posts):
    hist = {r.bucket: r.groups for r in report.histogram(posts, "post_id").collect()}
    assert hist == {"1-10": 2, "11-50": 1, "51-100": 0, "101-500": 0, "501-1000": 0, ">1000": 0}
    assert report.retention(posts, posts.limit(0)).first().retained_percent == 0 and report.retention(posts.limit(0), posts.limit(0)).first().retained_percent is None
    assert report.duplicates(spark.createDataFrame([("a",), ("a",), (None,), (None,)], "x string"), "x").first().duplicates == 2
    assert {r.name: r.non_null for r in report.profile(posts).collect()}["post_id"] == 38


def test_csv_round_trip(spark, tmp_path):
    body = 'post_id,post_raw,comment_id,author,created_time,comment_raw\n1,"a ""q"", b",c1,ann,3d,"line one\nline two"\n2,short\n3,p,c3,bo,1h,NA,extra\n'
    (tmp_path / "v1_youtube.csv").write_text(body)
    strict = readers.read_scraped(spark, str(tmp_path))
    assert [(r.post_raw, r.comment_raw, r.created_date) for r in strict.orderBy("post_id").collect()] == [('a "q", b', "line one\nline two", "3d"), ("p", "NA", "1h")]
    assert readers.read_scraped(spark, str(tmp_path), strict=False).count() == 3
    out = writers.write_table(strict, str(tmp_path / "out.csv"))
    back = readers.read_stage(spark, out)
    assert back.count() == 2 and back.where("comment_raw is null").count() == 1
    writers.write_removed(strict.withColumn("removal_reason", F.lit("x y")), str(tmp_path / "gone"))
    assert spark.read.parquet(str(tmp_path / "gone")).count() == 2
    assert writers.named("a/b.csv", "model", "gpt-2.5") == "a/b_gpt_2_5.csv" and writers.named("a", "cancel") is None
    assert writers.named("a/b.csv", "stamp", "m", datetime.datetime(2024, 1, 2, 3, 4, 5)) == "a/b_m_20240102_030405.csv"
    line = strict.select(writers.csv_line(F.lit('a"b'), F.lit(None))).first()[0]
    assert line == '"a""b",""' and readers.stage_path("r/", "v1", "raw", "x") == "r/v1/raw/x"
    assert spark.range(1).select(readers.fix_breaks(F.lit("a\r\n\nb"))).first()[0] == "a\n\nb"


def test_html(spark):
    page = '<div class="c big"><p>One <b>two</b></p><p> </p><p>three</p><br><a href="http://x/a">go</a><a name="q">no</a></div><p>open'
    df = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    assert [(r.text, r.value) for r in html.elements(df, "page_id", "a", "href", "http").collect()] == [("go", "http://x/a")]
    assert [r.text for r in html.elements(df, "page_id", "p").orderBy("n").collect()] == ["One two", "", "three", "open"]
    assert df.select(html.joined_paragraphs(F.col("html"))).first()[0] == "One two three"
    urls = spark.createDataFrame([("facebook", "https://f/permalink/123/"), ("tiktok", "https://t/@a/video/77?x=1"), ("youtube", "https://y/watch?a=1&v=Q_-1&t=2"), ("reddit", "https://r/r/x/comments/ab1/t"), ("threads", "https://t/@a/post/Zz"), ("other", "u")], "p string, u string")
    assert [r[0] for r in urls.select(html.post_id(F.col("u"), F.col("p"))).collect()] == ["123", "77", "Q_-1", "ab1", "Zz", ""]
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, ""), (1, 3, "c")], "post long, n int, t string")
    assert {r.comment_id for r in html.numbered_comments(rows, "post", "n", F.col("t") != "").collect()} == {"1_1", "1_2"}
    assert {r.comment_id for r in html.numbered_comments(rows, "post", "n", F.col("t") != "", gaps=True).collect()} == {"1_1", "1_3"}


def test_streams(spark, tmp_path):
    schema = "id long, key string, author string, comment_raw string, created_date string, ts timestamp"
    t = datetime.datetime(2024, 1, 1, 10, 0)
    rows = [(1, "k", "a", "x", "d", t), (2, "k", "a", "x", "d", t + datetime.timedelta(seconds=5)), (3, "k", "b", "y", "d", t + datetime.timedelta(seconds=9))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    streams.drain(streams.dedup(stream()), str(tmp_path / "d"), str(tmp_path / "dc")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2
    streams.drain(streams.quota(stream(), 2), str(tmp_path / "q"), str(tmp_path / "qc")).awaitTermination(120)
    assert sorted((r.id, r.admitted) for r in spark.read.parquet(str(tmp_path / "q")).collect()) == [(1, True), (2, True), (3, False)]
    streams.drain(streams.dedup(stream()), str(tmp_path / "d"), str(tmp_path / "dc")).awaitTermination(120)  # nothing new
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2


def test_key_pool():
    from tidemill.operators.throttle import KeyPool

    t = datetime.datetime(2024, 1, 1, 10, 0, 20)
    pool = KeyPool(["key-aaaa", "key-bbbb"], per_minute=2, per_day=3)
    assert [pool.take(t) for _ in range(5)] == ["key-aaaa"] * 2 + ["key-bbbb"] * 2 + [None]
    assert pool.wait_seconds(t) == 45 and pool.take(t + datetime.timedelta(seconds=45)) == "key-bbbb"
    pool.rotate()
    assert pool.take(t + datetime.timedelta(seconds=46)) == "key-aaaa"
    now = [t + datetime.timedelta(seconds=50)]
    with pytest.raises(RuntimeError):
        pool.acquire(lambda: now[0], lambda s: None)
    assert pool.usage() == [("aaaa", 1, 3), ("bbbb", 1, 3)] and pool.take(t + datetime.timedelta(days=1)) is not None
    gap = KeyPool(["k"], 1, 9, tumbling=False)
    assert gap.take(t) and gap.take(t + datetime.timedelta(seconds=59)) is None and gap.take(t + datetime.timedelta(seconds=61))
