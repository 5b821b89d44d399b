"""Places over blocks, call schedules, ledgers of model runs, published tables."""

import collections
import json
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill import rules
from tidemill.operators import groups, label, places, schedule
from tidemill.plans import ledger, models
from tidemill.sources import readers, tables


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with most rows, small ones, null as a group, ties and null values."""
    rng = np.random.default_rng(1)
    rows = [(i, "hot" if i % 10 < 7 else None if i % 10 == 7 else f"g{i % 31}", int(rng.integers(0, 50)) if i % 13 else None, "x") for i in range(3000)]
    return spark.createDataFrame(rows, "id long, g string, v long, seq string").repartition(7)


def plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_places(skewed):
    frame = skewed.toPandas().sort_values("id")
    got = places.ordinals(skewed, [F.col("id")]).toPandas().set_index("id")["_ord"]
    assert got.sort_index().tolist() == list(range(3000))
    got = places.sequence(skewed, "g", [F.col("id")]).toPandas().set_index("id")["seq"].sort_index()
    assert got.tolist() == (frame.groupby("g", dropna=False).cumcount() + 1).tolist()
    before = frame.assign(v=frame["v"].fillna(0)).groupby("g", dropna=False)["v"].transform(lambda v: v.cumsum() - v)
    got = places.running(skewed, [F.col("id")], "g", F.col("v")).toPandas().set_index("id")["running"].sort_index()
    assert got.tolist() == before.astype(int).tolist()
    whole = frame["v"].fillna(0).cumsum() - frame["v"].fillna(0)
    got = places.running(skewed, [F.col("id")], value=F.col("v")).toPandas().set_index("id")["running"].sort_index()
    assert got.tolist() == whole.astype(int).tolist()
    assert places.chunks(skewed, [F.col("id")], 50).groupBy("batch").count().where("count <> 50").isEmpty()
    assert places.ordinals(skewed.limit(0), [F.col("id")]).count() == 0 == places.sequence(skewed.limit(0), "g", [F.col("id")]).count()
    assert places.sequence(skewed, "g", [F.col("id")]).columns == ["id", "g", "v", "seq"]


def test_previous_and_sequences(spark, skewed):
    frame = skewed.toPandas().sort_values("id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = places.previous(skewed, [F.col("id")], "g", F.col("v")).toPandas().set_index("id").sort_index()
        rows = skewed.withColumn("ten", F.floor(F.col("id") / 500))
        both = places.sequences(rows, [F.col("g"), F.col("id")], {"a": ["g"], "seq": ["g", "ten"]})
        assert both.columns == ["id", "g", "v", "ten", "a", "seq"] and "SinglePartition" not in plans(both)
        both = both.toPandas().set_index("id").sort_index()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = frame.groupby("g", dropna=False)["v"].shift(1)
    assert [None if pd.isna(x) else x for x in got["previous"]] == [None if pd.isna(x) else x for x in expected]
    frame["ten"] = frame["id"] // 500
    assert both["a"].tolist() == (frame.groupby("g", dropna=False).cumcount() + 1).tolist()
    assert both["seq"].tolist() == (frame.groupby(["g", "ten"], dropna=False).cumcount() + 1).tolist()


def test_hot_groups_spread(spark, skewed):
    """No exchange to one partition, and the hot group's rows come from many blocks."""
    for df in (places.ordinals(skewed, [F.col("id")]), places.chunks(skewed, [F.col("id")], 50, "g"), readers.with_ordinal(skewed, "id"), groups.chunks(skewed, "g", [F.col("id")], 50)):
        assert "SinglePartition" not in plans(df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as blocks of full size are not merged
    try:
        rows = places._blocks(skewed, [F.col("g"), F.col("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = rows.where("g = 'hot'").groupBy("__places_part").count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) <= 3000 / 8 * 1.7


def next_fit(tokens, q):
    out, minute, calls, held = [], 0, 0, 0
    for n in tokens:
        if calls and (calls == q.per_minute or held + n > q.tokens):
            minute, calls, held = minute + 1, 0, 0
        calls, held = calls + 1, held + n
        out.append(minute)
    return out


@pytest.mark.parametrize(("start", "spent"), [(0, 0), (1430, 0), (10, 25), (10, 40)])
def test_schedule_keeps_quotas(spark, start, spent):
    rng = np.random.default_rng(4)
    rows = [(i, int(x), "a", "b") for i, x in enumerate(rng.integers(1, 400, 500))]
    rows += [(500, 5000, "a", "b"), (501, None, "a", "b"), (502, -3, "a", "b")]
    calls = spark.createDataFrame(rows, "id long, n long, slot string, key_no string").repartition(5)
    q = schedule.Quota(4, 900, 40)
    got = schedule.schedule(calls, 3, q, [F.col("id")], F.col("n"), start, spent).toPandas()
    assert len(got) == 503 and sorted(got.columns) == ["id", "in_slot", "key_no", "n", "over_tokens", "slot"]
    got["t"] = got["n"].fillna(0).clip(lower=0)
    per = got.groupby(["key_no", "slot"]).agg(c=("id", "count"), t=("t", "sum"), o=("over_tokens", "max"), last=("in_slot", "max"))
    assert (per.c <= 4).all() and (per.t[~per.o] <= 900).all() and (per.c[per.o] == 1).all() and (per["last"] == per.c - 1).all()
    days = got.assign(day=got.slot // 1440).groupby(["key_no", "day"]).size()
    assert (days <= 40).all() and (days[days.index.get_level_values("day") == 0] <= 40 - spent).all()
    assert got.slot.min() == (start if spent < 40 else 1440)
    for key, own in got.sort_values("id").groupby("key_no"):
        first = max(0, 40 - spent)
        cut = [own.iloc[:first], *(own.iloc[i : i + 40] for i in range(first, len(own), 40))]
        at = 0
        for d, part in enumerate(cut):
            begin = start if d == 0 else 0
            expected = next_fit(part.t.astype(int).tolist(), q)
            assert part.slot.tolist() == [at * 1440 + begin + m for m in expected], key
            at += -(-(max(expected) + 1 + begin) // 1440) if expected else 1


def test_schedule_runs_over_days(spark):
    """Calls that need more than a day of minutes push the next day's back."""
    q = schedule.Quota(1, 10, 2000)
    got = schedule.schedule(spark.range(2500), 1, q, [F.col("id")]).orderBy("id").toPandas()
    assert got.slot.tolist() == list(range(2000)) + list(range(2880, 3380))
    assert schedule.schedule(spark.range(0), 2, q, [F.col("id")]).count() == 0
    assert schedule.Quota.of("unknown", 0.9) == schedule.Quota(9, 225000, 225)


def asked(folder):
    return collections.Counter(p for f in os.listdir(folder) for p in (json.loads(open(f"{folder}/{f}").read())["prompt"],))


def recording(folder, stop_at=None, answer=lambda p: p.upper()):
    """A client that writes down each call; from the stop_at-th on the process's task dies."""

    def make(key=None):
        def client(prompt):
            if stop_at is not None and len(os.listdir(folder)) >= stop_at:
                raise SystemExit("killed")
            with open(f"{folder}/{time.time_ns()}-{os.getpid()}", "w") as f:
                f.write(json.dumps({"prompt": prompt, "key": key, "t": time.time()}))
            return answer(prompt)

        return client

    return make


def test_killed_run_goes_on(spark, tmp_path):
    calls = spark.createDataFrame([(i, f"p{i % 40}" if i % 11 else None) for i in range(60)], "id long, prompt string")
    (tmp_path / "log").mkdir()
    book = ledger.Ledger(spark, f"file://{tmp_path}/ledger")
    with pytest.raises(Exception):
        book.run(calls, recording(f"{tmp_path}/log", stop_at=23), wave=10)
    done = {r.call_id for r in book.finished().collect()}
    assert len(done) == 20 and len(book.waves()) == 2
    first = asked(tmp_path / "log")
    got = {r.id: r.response for r in book.run(calls, recording(f"{tmp_path}/log"), wave=10).collect()}
    prompts = {p for (p,) in calls.select("prompt").where("prompt is not null").distinct().collect()}
    assert got == {i: f"P{i % 40}" if i % 11 else None for i in range(60)}
    after = asked(tmp_path / "log")
    known = {r.prompt for r in calls.select("prompt", ledger.call_id(F.col("prompt")).alias("c")).collect() if r.c in done}
    assert all(after[p] == first[p] == 1 for p in known) and set(after) == prompts
    assert book.run(calls, recording(f"{tmp_path}/log", stop_at=0), wave=10).count() == 60  # nothing is left to ask
    (tmp_path / "log2").mkdir()
    whole = ledger.Ledger(spark, f"file://{tmp_path}/other").run(calls, recording(f"{tmp_path}/log2"))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, book.answers(calls).collect()), key=str)


def test_failed_calls_are_tried_by_the_next_run(spark, tmp_path):
    calls = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id long, prompt string")
    book = ledger.Ledger(spark, f"file://{tmp_path}/ledger")

    def fails():
        def client(prompt):
            if prompt in ("p1", "p4"):
                raise ValueError("refused")
            return "ok"

        return client

    assert {r.id for r in book.run(calls, fails, attempts=2).where("response is null").collect()} == {1, 4}
    assert {r.response for r in book.run(calls, lambda: lambda p: "later").where("id in (1, 4)").collect()} == {"later"}
    assert book.run(calls.limit(0), fails).count() == 0


@pytest.mark.parametrize("workers", [1, 4])
def test_paced_run_keeps_quotas(spark, tmp_path, workers):
    calls = spark.createDataFrame([(i, f"p{i}") for i in range(14)], "id long, prompt string")
    (tmp_path / "log").mkdir()
    book = ledger.Ledger(spark, f"file://{tmp_path}/ledger")
    pace = ledger.Pace(2, schedule.Quota(2, 1 << 40, 1000), minute=4.0, guard=0.1, lead=3.0)
    spark.conf.set("spark.sql.shuffle.partitions", str(workers))
    try:
        got = {r.id: r.response for r in book.run_paced(calls, recording(f"{tmp_path}/log"), pace, slots=4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {i: f"P{i}" for i in range(14)}
    made = [json.loads(open(f"{tmp_path}/log/{f}").read()) for f in os.listdir(tmp_path / "log")]
    per = collections.Counter((m["key"], int(m["t"] // 4)) for m in made)
    assert len(made) == 14 and max(per.values()) <= 2


def test_labels_once_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, "s", "a"), (1, "s", "b"), (None, "s", "c"), (2, "s", "d"), (1, "t", 'e "q" \n'), (3, None, "f"), (None, None, None), (4, "t", None)]
    df = spark.createDataFrame(rows, "comment_id long, summary string, comment_raw string")
    own = rules.RuleSet()
    (tmp_path / "log").mkdir()
    answer = lambda p: json.dumps({k: "A" for k in json.loads(p)})
    out = models.label_all(df, own, recording(f"{tmp_path}/log", answer=answer), [F.col("comment_id"), F.col("comment_raw")], template="{comments}")
    got = sorted((str(r.comment_id), str(r.comment_raw), r.label) for r in out.collect())
    assert [(i, x) for i, _, x in got] == [("1", "A")] * 3 + [("2", "A"), ("3", ""), ("4", "A"), ("None", ""), ("None", "NEUTRAL")]
    calls = asked(tmp_path / "log")
    assert {json.dumps(json.loads(p), sort_keys=True) for p in calls} == {'{"1": "b", "2": "d"}', '{"1": "e \\"q\\" \\n", "4": ""}'}
    out.count()
    assert asked(tmp_path / "log") == calls  # a second action asks nobody
    book = ledger.Ledger(spark, f"file://{tmp_path}/ledger")
    again = models.label_all(df, own, recording(f"{tmp_path}/log", answer=answer), [F.col("comment_id"), F.col("comment_raw")], template="{comments}", ledger=book)
    assert sorted((str(r.comment_id), str(r.comment_raw), r.label) for r in again.collect()) == got
    models.label_all(df, own, recording(f"{tmp_path}/log", stop_at=0), [F.col("comment_id"), F.col("comment_raw")], template="{comments}", ledger=book).count()


def test_summaries_resume(spark, tmp_path):
    df = spark.createDataFrame([(i, f"post {i % 7}" if i else None) for i in range(20)], "id long, post_raw string")
    (tmp_path / "log").mkdir()
    book = ledger.Ledger(spark, f"file://{tmp_path}/ledger")
    answer = lambda p: json.dumps({"results": [{"id": x["id"], "summary": x["text"][-1]} for x in json.loads(p)]})
    with pytest.raises(Exception):
        models.summarise(df, recording(f"{tmp_path}/log", stop_at=2, answer=answer), ledger=book, wave=3, clients=1)
    n = book.finished().count()
    assert 0 < n < 7
    got = models.summarise(df, recording(f"{tmp_path}/log", answer=answer), ledger=book, wave=3, clients=1)
    assert {r.id: r.summary for r in got.collect()} == {i: str(i % 7) if i else None for i in range(20)}


def test_compare_by_position(spark):
    a = spark.createDataFrame([(i, f"c{i}", "A" if i % 3 else "B") for i in range(50)], "id long, comment_raw string, label string").repartition(4)
    b = spark.createDataFrame([(100 - i, "A" if i % 4 else None) for i in range(50)], "rank long, label string").repartition(3)
    got = label.compare_by_position(a, b, [F.col("id")], [F.col("rank").desc()])
    rows = {r["index"]: (r.model1_label, r.model2_label, r.same) for r in got.collect()}
    assert rows == {i: ("A" if i % 3 else "B", "A" if i % 4 else None, bool(i % 3 and i % 4)) for i in range(50)}
    assert [r["index"] for r in label.differences(got, 5).collect()] == [0, 3, 4, 6, 8]
    lines = [x for r in label.comparison_report(got, shown=3).collect() for x in r.value.split("\n")]
    assert lines[:4] == ["Records: 50", "Same labels: 25", "Different labels: 25", "Agreement: 50.0 %"] and lines[-1] == "4. c4 | A | -" and len(lines) == 9
    assert label.compare_by_position(a, b.limit(3), [F.col("id")], [F.col("rank")]) is None


def test_published_versions(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    one = spark.range(5)
    assert tables.publish(one, root) == 1 and tables.published(spark, root).count() == 5
    assert tables.publish(tables.published(spark, root).union(spark.range(2)), root) == 2  # reads what it replaces
    bad = spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        tables.publish(bad, root)
    assert tables.published(spark, root).count() == 7 and tables.version(spark, root) == 2
    with pytest.raises(FileExistsError):
        tables.publish(spark.range(1), root, seen=1)  # made from a version that another writer has replaced
    assert tables.published(spark, root, 1).count() == 5
    tables.publish(spark.range(3), root)
    tables.forget(spark, root, keep=1)
    assert tables.published(spark, root).count() == 3 and len([n for n in tables.names(spark, root) if n.startswith("rows-")]) == 1
    with pytest.raises(FileNotFoundError):
        tables.published(spark, f"{root}x")


def test_strict_width(spark, tmp_path):
    body = 'post_id,post_raw,comment_id,author,created_time,comment_raw\n1,p,c1,a,t,"six\nlines, ""q"""\n2,p,c2,a,t\n3,p,c3,a,t,\n4,p,c4,a,t,seven,more\n5,"p,\n,",c5,a,"t, t"\n6,p,c6,a,t,,\n7,,,,,\n'
    (tmp_path / "x.csv").write_text(body)
    got = readers.read_scraped(spark, str(tmp_path)).orderBy("post_id").collect()
    import csv

    expected = [r[:6] for r in csv.reader(body.splitlines(keepends=True)) if len(r) >= 6][1:]
    assert [[x or "" for x in r[:6]] for r in got] == expected and [r[0] for r in expected] == ["1", "3", "4", "6", "7"]
    assert readers.read_scraped(spark, str(tmp_path), strict=False).count() == 7


def test_broken_file_fails_alone(spark, tmp_path):
    from tidemill.plans import files

    (tmp_path / "in").mkdir()
    head = "post_id,post_raw,comment_id,author,created_time,comment_raw\n"
    for k in range(9):
        rows = "".join(f"{k},p,c{k}_{i},a,t,{'long words here' if i % 3 else 'x'}\n" for i in range(k))
        (tmp_path / f"in/f{k}.csv").write_bytes((head + rows).encode() + (b"9,p,c,a,t,\xff\xfe\n" if k in (3, 7) else b""))
    paths = [f"{tmp_path}/in/f{k}.csv" for k in range(9)]
    short = F.length("comment_raw") < 4
    step = lambda df: (df.where(~short), df.where(short))
    got = {r.file: r for r in files.run_files(spark, paths, step, f"file://{tmp_path}/out").collect()}
    for k in range(9):
        r, lost = got[f"f{k}.csv"], (k + 2) // 3
        if k in (3, 7):
            assert "UTF-8" in r.error and r.rows_in is None and (r.kept, r.removed) == (0, 0)
        else:
            assert (r.rows_in, r.kept, r.removed, r.error) == (k, k - lost, lost, None)
    kept = spark.read.parquet(*(f"{tmp_path}/out/kept/{d}" for d in os.listdir(tmp_path / "out/kept")))
    assert {r.file_name for r in kept.select("file_name").distinct().collect()} == {f"f{k}.csv" for k in (2, 4, 5, 6, 8)}
    assert not [d for d in os.listdir(tmp_path / "out") if d.startswith("_open")]


def test_stream_stops_when_quiet(spark, tmp_path):
    import threading

    from tidemill.streaming import streams

    (tmp_path / "in").mkdir()

    def put(k):
        pd.DataFrame({"id": [k]}).to_parquet(tmp_path / f"in/.f{k}")
        os.rename(tmp_path / f"in/.f{k}", tmp_path / f"in/f{k}.parquet")

    put(0)
    feeding = threading.Thread(target=lambda: [(time.sleep(0.8), put(k)) for k in range(1, 5)])
    writer = spark.readStream.schema("id long").parquet(f"{tmp_path}/in").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at")
    feeding.start()
    n = streams.until_quiet(writer, spark, triggers=8, interval="500 milliseconds", timeout=90)
    feeding.join()
    assert n == 5 == spark.read.parquet(f"{tmp_path}/out").count()
    put(5)
    again = spark.readStream.schema("id long").parquet(f"{tmp_path}/in").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at")
    assert streams.until_quiet(again, spark, triggers=2, interval="300 milliseconds", most=1, timeout=60) == 1


def test_streamed_quota_equals_batch(spark, tmp_path):
    """Requests out of order within the delay; a key that falls silent loses its state."""
    from tidemill.operators import capacity
    from tidemill.streaming import streams

    rng = np.random.default_rng(8)
    rows, at = [], {k: 1_700_000_000.0 for k in "abc"}
    for i in range(240):
        k = "abc"[i % 3]
        at[k] += float(rng.choice([3, 20, 70])) + i * 1e-4
        rows.append((i, k, pd.Timestamp(at[k], unit="s")))
    frame = pd.DataFrame(rows, columns=["id", "key", "ts"]).sort_values("ts").reset_index(drop=True)
    frame["n"] = np.arange(len(frame)) // 40
    (tmp_path / "in").mkdir()
    for n, own in frame.groupby("n"):
        own.sample(frac=1, random_state=1).drop(columns="n").to_parquet(tmp_path / f"in/f{n}.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    late = frame.ts.max() + pd.Timedelta("1 day")
    pd.DataFrame({"id": [999], "key": ["z"], "ts": [late]}).to_parquet(tmp_path / "in/f8.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    pd.DataFrame({"id": [1000], "key": ["z"], "ts": [late + pd.Timedelta("1 day")]}).to_parquet(tmp_path / "in/f9.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    for n in range(10):
        if os.path.exists(p := tmp_path / f"in/f{n}.parquet"):
            os.utime(p, (1_000_000 + n, 1_000_000 + n))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        stream = spark.readStream.schema("id long, key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = streams.ordered_quota(stream, 2, delay="10 minutes").writeStream.format("memory").queryName("admitted").outputMode("append").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start()
        query.awaitTermination(240)
        assert query.exception() is None
        got = {r.id: (r.in_burst, r.admitted) for r in spark.table("admitted").collect()}
        states = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    batch = capacity.quota_gaps(spark.createDataFrame(frame.drop(columns="n")), 2)
    expected = {r.id: (r.in_burst, r.admitted) for r in batch.collect()}
    assert {i: got[i] for i in expected} == expected and 999 in got
    assert states < 12  # what is left belongs to the last key


def test_lookup_reads_one_file(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 3).alias("k"), F.col("id").cast("string").alias("v")).union(spark.createDataFrame([(None, "none"), (30, "again")], "k long, v string"))
    path = tables.write_sorted(rows, f"file://{tmp_path}/t", "k", 100)
    got = tables.lookup(spark, path, "k", [30])
    assert sorted(r.v for r in got.collect()) == ["10", "again"] and len(got.inputFiles()) == 1
    assert len(spark.read.parquet(f"{path}/rows").inputFiles()) >= 8
    assert tables.lookup(spark, path, "k", [31, None]).count() == 0 == tables.lookup(spark, path, "k", [10**9]).count()
    assert sorted(r.k for r in tables.lookup(spark, path, "k", [0, 2997]).collect()) == [0, 2997]


def test_large_lexicon_is_the_sequential_rewrite(spark):
    from tidemill.functions import lexicon
    from tidemill.functions import text as T

    rng = np.random.default_rng(6)
    letters = list("abcde") + ["é", "K", "ß", "+", ":", "3", "_", "é"]
    word = lambda n: "".join(rng.choice(letters, n))
    entries = [(word(rng.integers(1, 4)), word(rng.integers(0, 4))) for _ in range(60)] + [("c++", "$1\\"), ("***", "ab"), ("ab", "***"), ("i", "İ"), ("k", "KK"), ("a b", "c")]
    texts = [" ".join(word(rng.integers(1, 5)) for _ in range(rng.integers(0, 25))) for _ in range(150)] + ["", None, "İ ı K ſ ß", "C++ c++c", "***ab", "A b a B"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = df.select("i", "t", T.lexical(F.col("t"), entries).alias("a"), lexicon.rewritten(F.col("t"), entries).alias("b")).collect()
    assert all(r.a == r.b for r in got), [r for r in got if r.a != r.b][:3]
    many = [(f"w{k}", f"v{k}") for k in range(10_000)]
    out = spark.createDataFrame([("W1 w9999 w10000 xw5",)], "t string").select(lexicon.rewritten(F.col("t"), many).alias("x")).first().x
    assert out == "v1 v9999 w10000 xw5"
    assert spark.range(1).select(lexicon.rewritten(F.lit("as it is"), []).alias("x")).first().x == "as it is"


def test_quick_waves_grow_and_sized_ones_do_not(spark, tmp_path):
    from tidemill.plans.ledger import Ledger

    calls = spark.range(440).select(F.concat(F.lit("p"), F.col("id")).alias("prompt"))
    for wave, n in ((None, 4), (200, 3)):  # 50, 100, 200, 90; before, nine waves of 50
        book = Ledger(spark, str(tmp_path / f"waves{n}"))
        said = book.run(calls, lambda: str.upper, wave)
        assert len(book.waves()) == n
        assert {(r.prompt, r.response) for r in said.collect()} == {(f"p{i}", f"P{i}") for i in range(440)}


def test_a_lexicon_searches_a_text_once_and_the_surroundings_of_replacements():
    from tidemill.functions import lexicon

    own = lexicon.Rewriter([(f"w{k}", f"<v{k}>") for k in range(1000)] + [("<v5> ", "x"), ("x <", "y")])
    real, seen = own.automaton, []

    class Counted:
        def iter(self, text):
            seen.append(len(text))
            return real.iter(text)

    own.automaton = Counted()
    text = " ".join(f"W{k}" for k in range(1000))
    assert own.rewrite(text) == " ".join(f"<v{k}>" for k in range(1000))
    assert sum(seen) < 10 * len(text)  # before, the whole text once for each entry in it
    assert own.rewrite("w5 w6 xw7") == "<v5> <v6> xw7"
    assert lexicon.Rewriter([("ab", "c d"), ("c", "e"), ("d", "d f")]).rewrite("AB abc ab") == "e d f abc e d f"


def test_long_backup(spark, tmp_path):
    import datetime

    from tidemill.sources import writers

    df = spark.createDataFrame([(1, "a b c"), (2, "a b c d e"), (3, None)], "id long, comment_raw string")
    at = datetime.datetime(2024, 5, 6, 7, 8, 9)
    path = writers.write_long(df, f"file://{tmp_path}", 4, now=at)
    assert path.endswith("long_comments_removed_20240506_070809.parquet")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("a b c d e", 5, "Comment longer than 4 words")]
    assert writers.write_long(df, f"file://{tmp_path}", 9) is None
