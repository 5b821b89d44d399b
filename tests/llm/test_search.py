"""Vector codes, ranked search and language identification against brute force, SQL and held-out rows."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_lexical_search"])
def test_sql(spark, name):
    from tidemill.llm import queries as Q

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    expected = con.sql(Q.SQL[name])
    rows = Q.QUERIES[name](spark, DATA).select(*expected.columns).collect()
    assert rows and sorted(map(tuple, rows)) == sorted(expected.fetchall())


def brute_codes(rows, rounds=6):
    """Plain Python: rows (id, vector, label) to code, error, label errors and the digest."""
    kept = [(i, [math.floor(4096 * x) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    w = len(kept[0][1]) // 8
    part = lambda v, p: v[p * w : (p + 1) * w]
    books = [[part(v, p) for _, v, _ in kept[:16]] for p in range(8)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(part(v, p), books[p])[1], []).append(part(v, p))
            for k, xs in own.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out, by = {}, {}
    for i, v, g in kept:
        best = [near(part(v, p), books[p]) for p in range(8)]
        out[i] = ("".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), g)
        by[g] = by.get(g, 0) + out[i][1]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return {i: (c, e, by[g], hashlib.sha256(text.encode()).hexdigest()) for i, (c, e, g) in out.items()}


def coded(spark, rows, schema="vec_id long, embedding array<double>, label int, _c string, code string"):
    from tidemill.llm import vectors

    codes, books = vectors.compress(spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3))
    got = vectors.with_label_errors(codes).collect()
    return {r.id: (bytes(r.code).hex(), r.error, r.label_error, vectors.books_digest(books)) for r in got}, len(got)


def test_vector_codes_odd(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).round(2).tolist(), None if i % 7 == 0 else i % 3) for i in range(120)]
    rows += [(200 + i, rows[5][1], 1) for i in range(40)]  # copies
    bad = [(300, None, 1), (301, [1.0] * 15 + [None], 1), (302, [math.nan] + [0.0] * 15, 1), (303, [math.inf] + [0.0] * 15, None), (-1, [-math.inf] * 16, 2)]
    got, n = coded(spark, rows + bad)
    assert got == brute_codes(rows + bad) and n == 160
    few = rows[:5]
    assert coded(spark, few)[0] == brute_codes(few)
    assert coded(spark, rows[:3] + [(400, [1.0] * 8, 1), (401, [], 1)])[0] == brute_codes(rows[:3])  # other lengths go
    assert coded(spark, bad) == ({}, 0)
    twice, n = coded(spark, [*rows[:20], rows[3], (None, rows[4][1], 1)])
    assert n == 22 and None in twice
    huge, n = coded(spark, [(1, [1e300] * 16, 1), (2, [-1e300] * 16, 1), (3, [0.5] * 16, None)])
    assert n == 3 and all(e == 0 for _, e, _, _ in huge.values())


def test_exponion_finds_the_nearest():
    from tidemill.llm.vectors import nearest

    rng = np.random.default_rng(2)
    entries = rng.integers(-50, 50, (16, 4)) * 10
    entries[9] = entries[2]
    x = entries[rng.integers(0, 16, 4000)] + rng.integers(-12, 13, (4000, 4))
    x[:50] = (entries[1] + entries[4]) // 2
    start = rng.integers(0, 16, 4000)
    far = ((x[:, None] - entries[None]) ** 2).sum(2)
    code, best, _ = nearest(x, entries, start)
    assert (code == far.argmin(1)).all() and (best == far.min(1)).all()
    again, _, computed = nearest(x, entries, code)
    assert (again == code).all() and computed < 3 * len(x)


def test_decode(spark):
    from tidemill.llm import vectors

    rows = [(i, [float(i % 2)] * 16, 0) for i in range(6)]
    codes, books = vectors.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert {r.id: r.vector for r in vectors.decode(codes, books).collect()} == {i: v for i, v, _ in rows}


def brute_search(docs, items, k=10):
    low = lambda t: TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    docs = [(i, low(t)) for i, t in docs]
    held = [(i, t) for i, t in docs if t]
    n, total = len(held), sum(len(t) for _, t in held)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(low(t))
    out = {}
    for item, own in terms.items():
        found = []
        for i, t in held:
            m, score = 100 - 90 + (90 * len(t) * n) // total, 0
            for x in own & set(t):
                df = sum(x in u for _, u in held)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out[item] = [(r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return {i: x for i, x in out.items() if x}


def searched(spark, docs, items, **more):
    from tidemill.llm import lexical

    docs = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, item_id string, score string").repartition(2)
    items = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string")
    index = lexical.build_index(docs, shard_bytes=more.pop("shard_bytes", lexical.SHARD))
    got = {}
    for r in sorted(lexical.search(index, items, **more).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return got


def test_search_odd(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "İstanbul", "日本", "ABC", "abc", "7"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "?! -"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (103, "a" * 70_000 + " w5 " * 9000), (5, docs[5][1])]
    docs += [(200 + i, "w1,w2;W3") for i in range(30)]  # ties
    items = [(1, "w1 w2 w3"), (2, "abc É nothing"), (3, None), (4, "--"), (5, " ".join(words)), (None, "w7 w8"), (None, "w9"), (6, "7 istanbul"), (7, "w1_w1+w1")]
    expected = brute_search(docs, items)
    assert searched(spark, docs, items) == expected
    assert searched(spark, docs, items, shard_bytes=200, block=4) == expected  # many shards, an item or two a pass
    assert searched(spark, docs, items, k=3) == brute_search(docs, items, 3)
    assert searched(spark, [], items) == {} == searched(spark, [(1, None), (2, "...")], items) == searched(spark, docs, [])


def test_best_is_tie_safe():
    from tidemill.llm.lexical import best

    scores = np.array([0, 5, 9, 5, 5, 0, 9, 1])
    assert sorted(best(scores, 4).tolist()) == [1, 2, 3, 6] and sorted(best(scores, 9).tolist()) == [1, 2, 3, 4, 6, 7]


def test_language_words():
    from tidemill.llm.langid import word_array

    texts = ["Déjà-vu, l'Été « 12x » 3×4 “Ünï”…", "", "日本、中国 😀ok", None]
    words, sizes = word_array([(t or "").encode() for t in texts])
    assert [w.decode() for w in words.to_pylist()] == ["déjà", "vu", "l", "été", "x", "ünï", "日本", "中国", "ok"] and sizes.tolist() == [6, 0, 3, 0]


def test_language_backoff():
    """Each word is scored by its longest known order, as plain Python does it."""
    from tidemill.llm import langid

    en, de = ["the", "thing", "with"], ["der", "ding", "mit"]
    counts = {"de": {w: 10 for w in de}, "en": {w: 10 for w in en}}

    def entries(word, order):
        marked = f"\x02{word}\x03"
        return [word] if not order else [g for g in (marked[i : i + order] for i in range(len(marked) - order + 1)) if g not in "\x02\x03"]

    learned = {o: {lang: {} for lang in counts} for o in langid.ORDERS}
    for lang, own in counts.items():
        for w, n in own.items():
            for o in langid.ORDERS:
                for g in entries(w, o):
                    learned[o][lang][g] = learned[o][lang].get(g, 0) + n
    words = pa.array(["the", "ding", "thinge", "mitx", "zzz", "tze"], pa.large_binary())
    orders = {}
    for o in langid.ORDERS:
        rows = []
        for k, lang in enumerate(counts):
            total = sum(learned[o][lang].values())
            for g, n in learned[o][lang].items():
                rows.append((g, k, n, total))
        missing = np.array([round(langid.STEP * math.log(0.5 / sum(learned[o][lang].values()))) for lang in counts])
        key = {}
        for g in {r[0] for r in rows}:
            if o:
                letters = langid.Letters(pa.array([g.strip("\x02\x03").encode()], pa.large_binary()))
                own, h = letters.grams(o)
                marked = entries(g.strip("\x02\x03"), o)
                key[g] = h[marked.index(g)]
            else:
                key[g] = langid.Letters(pa.array([g.encode()], pa.large_binary())).grams(0)[1][0]
        rows.sort(key=lambda r: (key[r[0]], r[1]))
        h = np.array([key[r[0]] for r in rows], np.uint64)
        keys, first = np.unique(h, return_index=True)
        who = np.array([r[1] for r in rows])
        orders[o] = (keys, np.append(first, len(h)), who, np.array([round(langid.STEP * math.log(r[2] / r[3])) for r in rows]) - missing[who], missing)
    model = langid.Model(list(counts), 0, 0.5, orders)
    got, known = langid.word_scores(model, words)

    def brute(word):
        for o in langid.ORDERS:
            seen = [g for g in entries(word, o) if any(g in learned[o][lang] for lang in counts)]
            if seen:
                out = []
                for k, lang in enumerate(counts):
                    low = orders[o][4][k]
                    total = sum(learned[o][lang].values())
                    out.append(low + sum(round(langid.STEP * math.log(learned[o][lang][g] / total)) - low if g in learned[o][lang] else 0 for g in seen) // len(seen))
                return out
        return None

    for i, w in enumerate(["the", "ding", "thinge", "mitx", "zzz", "tze"]):
        assert (brute(w) is not None) == known[i] and (not known[i] or got[i].tolist() == brute(w)), w


def test_language_id(spark):
    from tidemill.llm import langid

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in langid.language_id(docs).collect()}
    held = 0
    for r in docs.select("doc_id", "lang").collect():
        own = got[r.doc_id]
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= own.score <= 1
        held += own.held_out
        assert not own.held_out or own.lang_pred == r.lang
    assert held > 200 and len(got) == docs.count()


def test_language_id_odd(spark):
    from tidemill.llm import langid

    en, de = "the cat with the hat and the thing that is there", "der Hund mit dem Hut und das Ding ist da"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de", "x", "y") for i in range(40)]
    rows += [(100, None, "en", "", ""), (101, "", "de", "", ""), (102, "12 + 34 = 46 !?", "de", "", ""), (103, "the thing " * 50_000, None, "", ""), (104, "日本語", None, "", ""), (None, de, "de", "", ""), (1, en, "en", "", ""), (105, "unddas", None, "", ""), (106, "the", "fr" if zlib.crc32(b"106") % 4 == 2 else None, "", "")]
    schema = "doc_id long, text string, lang string, lang_pred string, score string"
    df = spark.createDataFrame(rows, schema)
    got = langid.language_id(df).collect()
    assert len(got) == len(rows) and [tuple(r) for r in sorted(got, key=str)] == [tuple(r) for r in sorted(langid.language_id(df.repartition(5)).collect(), key=str)]
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[102].score == 0
    assert by[103].lang_pred == "en" and by[105].lang_pred == "de" and by[104].lang_pred in ("en", "de") and by[106].lang_pred == "en"
    assert by[None].lang_pred == "de" and not by[None].held_out
    nothing = langid.language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and {r.score for r in nothing} == {0.0}
    assert langid.language_id(df.limit(0)).count() == 0
