"""Model plans: answers read, keys rotated, maps merged."""

import json

from pyspark.sql import functions as F

from tidemill.functions import jsontext
from tidemill.operators.throttle import KeyPool
from tidemill.plans import models


def test_repair_quotes_bare_names():
    assert json.loads(jsontext.repair('{results: [{id: "id1", summary : "a: {b}, c: d"}, {id: "id2", n: 3}]}')) == {"results": [{"id": "id1", "summary": "a: {b}, c: d"}, {"id": "id2", "n": 3}]}
    assert json.loads(jsontext.repair('{"a": [true, null, 1], "b": false}')) == {"a": [True, None, 1], "b": False}


def test_prompted():
    said = json.dumps({"results": [{"id": "id2", "summary": "x"}, {"id": "id9", "summary": "y"}, {"id": "id2", "summary": "z"}]})
    assert models.prompted(lambda p: f"Here: {said}")(["a", "b", "c"]) == [None, "z", None]
    text = "1. About: one\n2. Issue: two\n3. Flag: three\n"
    names = ("1. About:", "2. Issue:", "3. Flag:")
    assert models.prompted(lambda p: text, headings=names)(["a", "b"]) == ["1. About:one\n2. Issue:two\n3. Flag:three", None]
    assert models.prompted(lambda p: "no", headings=names, placeholder="?")(["a", "b"]) == ["?", "?"]


def test_keys_rotate_after_failures(spark):
    asked = []

    def client(key, prompt):
        asked.append(key)
        if key == "k1":
            raise ValueError("refused")
        return '{"results": [{"id": "id1", "summary": "s"}]}'

    call = models.prompted(models.keyed(client, KeyPool(["k1", "k2"], 100, 100)))
    from tidemill.operators.summarize import retried

    assert retried(lambda: call(["a"])) == ["s"] and asked == ["k1", "k2"]
    assert retried(lambda: 1 / 0) is None


def test_summarise_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "")], "id long, post_raw string")

    def make():
        def client(prompt):
            raise ValueError("down")

        return client

    got = {r.id: r.summary for r in models.summarise(df, make).collect()}
    assert got == {1: "", 2: "", 3: None, 4: ""}
    assert models.summarise(df.limit(0), make).count() == 0


def test_merged_maps(spark):
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    n = F.create_map(F.lit("b"), F.lit(3), F.lit("c"), F.lit(4))
    assert spark.range(1).select(jsontext.merged(m, n).alias("m")).first().m == {"a": 1, "b": 3, "c": 4}
