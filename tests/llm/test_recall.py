"""Planted fuzzy passages, and the streams that find them, against brute force."""

import collections

import numpy as np
import pytest


def planted(rng, n, words, percent):
    """Pairs of documents with a passage of so many words, so many of 100 changed but the first and the last."""
    fresh = lambda k: [f"w{x}" for x in rng.integers(0, 10**12, k)]
    docs = []
    for _ in range(n):
        w = fresh(words)
        v = list(w)
        for i in rng.choice(np.arange(1, words - 1), words * percent // 100, replace=False):
            v[i] = fresh(1)[0]
        docs += [" ".join([*fresh(40), *w, *fresh(50)]), " ".join([*fresh(60), *v, *fresh(30)])]
    return docs


def test_recall_at_the_threshold(spark):
    """The whole search finds at least 0.9 of the passages of every length and change, and nothing else."""
    from tidemill.llm import passages

    rng = np.random.default_rng(12)
    kinds = [(words, percent) for words in (50, 60, 100) for percent in (10, 20)]
    texts, of = [], []
    for kind in kinds:
        own = planted(rng, 40, *kind)
        texts, of = texts + own, of + [kind] * len(own)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    got = {(r.doc, r.partner) for r in passages.fuzzy_passages(df).collect()}
    assert all(d == p + 1 and d % 2 for d, p in got)
    found = collections.Counter(of[d] for d, _ in got)
    assert all(found[kind] >= 36 for kind in kinds), found


def test_common():
    """The longest common subsequence, as the table of all prefixes gives it; no limit to its size."""
    from tidemill.llm.passages import _common

    rng = np.random.default_rng(21)
    for _ in range(300):
        x, y = (rng.integers(0, 5, rng.integers(0, 30)) for _ in "xy")
        row = [0] * (len(y) + 1)
        for u in x:
            old = 0
            for j, v in enumerate(y, 1):
                old, row[j] = row[j], old + 1 if u == v else max(row[j], row[j - 1])
        assert _common(x.tolist(), y.tolist()) == row[-1]
    x = rng.integers(0, 60000, 5000).astype(np.uint16)
    assert _common(x.tolist(), np.delete(x, slice(1000, 2500)).tolist()) == 3500


def test_parts_of_a_chain():
    """A chain that is no passage as a whole gives the passages on both sides of its worst gaps."""
    from tidemill.llm.passages import K, align

    rng = np.random.default_rng(22)
    fresh = lambda n: rng.integers(0, 10**9, n)
    one, mid, two, more = fresh(90), fresh(150), fresh(110), fresh(40)
    half = mid[np.sort(rng.choice(150, 78, replace=False))]
    x, y = np.concatenate([one, mid, two]), np.concatenate([one, half[:39], more[:20], half[39:], two])
    matches = [(i, i) for i in range(0, 86, 5)] + [(240 + i, len(one) + 98 + i) for i in range(0, 106, 5)]
    got = align(x.tolist(), y.tolist(), matches)
    assert len(got) == 2 and all(len(set(x[a:b]) & set(y[c:d])) >= 0.8 * max(b - a, d - c) for a, b, c, d in got)
    assert got[0][0] == 0 and got[0][1] >= 90 and got[1][0] <= 240 and got[1][1] == 350
    assert align(x.tolist(), x.tolist(), [(i, i) for i in range(0, len(x) - K, 9)]) == [(0, 350, 0, 350)]
    assert align(fresh(300).tolist(), fresh(300).tolist(), [(10, 10), (200, 200)]) == []


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_pairs_of_seeds(spark, batch):
    """Pairs of seeds a passage's reach apart, numbered by document, as trying all pairs finds them; what is
    carried from batch to batch loses none."""
    from tidemill.llm import passages

    rng = np.random.default_rng(24)
    rows = [(int(rng.integers(0, 4)), int(d), int(at), None, None, None, None, bool(rng.random() < 0.8)) for d in range(1, 9) for at in np.sort(rng.choice(300, int(rng.integers(1, 40)), replace=False))]
    df = spark.createDataFrame(rows, "seed long, doc long, at int, one_doc long, one_at int, last_doc long, last_at int, more boolean")
    none = spark.createDataFrame([], "doc long, start long, end long, partner long, pstart long, pend long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted((r.doc, r.at, r.at2, r.ask, r.nth) for r in passages._pairs(df, none).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    asked = {r[0] for r in rows if r[7]}
    rows = [r for r in rows if r[0] in asked]
    of = collections.defaultdict(list)
    for a in rows:
        for b in rows:
            if a[1] == b[1] and passages.APART[0] <= b[2] - a[2] <= passages.APART[1]:
                of[a[0], b[0]].append((a[1], a[2], b[2], a[7] or b[7]))
    want = []
    for own in of.values():
        docs = sorted({d for d, *_ in own})
        if len(docs) > 1 and any(x[3] for x in own):
            want += [(*x, docs.index(x[0]) + 1) for x in own]
    assert got == sorted(want) and len(got) > 100


def test_hopeful():
    """Chains that are left out are those for which diagonal() finds nothing at once; others all stay."""
    import pyarrow as pa

    from tidemill.llm.passages import PERCENT, WORDS, diagonal, hopeful

    rng = np.random.default_rng(23)
    rows = []
    for k in range(400):
        x, y = (rng.integers(0, 250, int(rng.integers(4, 110))).astype(np.uint8) for _ in "xy")
        i, j = int(rng.integers(0, len(x) - 3)), int(rng.integers(0, len(y) - 3))
        back, size = min(i, j), min(i, j) + min(len(x) - i, len(y) - j)
        same = rng.random(size) < rng.choice([0.3, 0.8, 0.95])
        y[j - back : j - back + size][same] = x[i - back : i - back + size][same]
        more = 1 + int(k % 7 == 0)
        rows.append((1, 0, [i + 500] * more, [j + 90] * more, 500, x.tobytes(), 90, y.tobytes()))
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list("abcdefgh"))
    got = hopeful(batch.slice(0, 100)).tolist() + hopeful(batch.slice(100)).tolist()
    found = 0
    for (_, _, a, b, xs, x, ys, y), stays in zip(rows, got, strict=True):
        u, v, d = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), (b[0] - ys) - (a[0] - xs)
        lo, hi = max(0, -d), min(len(u), len(v) - d)
        assert stays == (len(a) > 1 or hi - lo >= WORDS and 100 * int((u[lo:hi] == v[lo + d : hi + d]).sum()) >= PERCENT * WORDS)
        passages = diagonal(u, v, [(a[0] - xs, b[0] - ys)])
        assert stays or not passages
        found += bool(passages)
    assert found > 20
    assert hopeful(batch.slice(0, 0)).tolist() == []


def test_diagonal():
    """The longest stretch that meets the rule, as trying all stretches finds it."""
    from tidemill.llm.passages import PERCENT, WORDS, diagonal

    rng = np.random.default_rng(13)
    for _ in range(200):
        n = int(rng.integers(40, 130))
        x = rng.integers(0, 10**6, n).astype(np.uint32)
        d = int(rng.integers(-5, 6))
        y = rng.integers(0, 10**6, n + 10).astype(np.uint32)
        i = np.arange(max(0, -d), n)
        y[i + d] = np.where(rng.random(len(i)) < rng.choice([0.7, 0.8, 0.85]), x[i], y[i + d])
        same = {int(k): bool(x[k] == y[k + d]) for k in i}
        if not any(same.values()):
            continue
        best = 0
        for a in (k for k in same if same[k]):
            good = 0
            for b in range(a, n):
                good += same[b]
                if same[b] and 100 * good >= PERCENT * (b - a + 1):
                    best = max(best, b - a + 1)
        got = diagonal(x, y, [(next(k for k in same if same[k]), next(k for k in same if same[k]) + d)])
        assert (got[0][1] - got[0][0] if got else 0) == (best if best >= WORDS else 0)
        for a, b, pa, pb in got:
            assert pa - a == pb - b == d and 100 * sum(same[k] for k in range(a, b)) >= PERCENT * (b - a)


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_places_in_a_stream(spark, batch):
    """First and last earlier documents of every seed, whatever the batches hold."""
    from tidemill.llm import passages

    rng = np.random.default_rng(14)
    rows = sorted({(int(min(rng.geometric(0.2), 9)), int(rng.integers(0, 8)), int(rng.integers(0, 30))) for _ in range(400)} | {(99, 1, k) for k in range(20)})
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "seed long, doc long, at int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted(tuple(r) for r in passages._places(df).collect())
        links = sorted(tuple(r) for r in passages._links(passages._places(df)).collect())
        chained = sorted((r.doc, r.partner, a, b) for r in passages._chains(passages._links(passages._places(df)), True).collect() for a, b in zip(r.a, r.b, strict=True))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    expected, pairs = [], []
    for seed in {s for s, _, _ in rows}:
        own = [(d, a) for s, d, a in rows if s == seed]
        if len({d for d, _ in own}) < 2:
            continue
        for d, a in own:
            earlier = [x for x in own if x[0] < d]
            one, last = (min(earlier), max(earlier)) if earlier else ((None, None), (None, None))
            expected.append((seed, d, a, *one, *last, bool(earlier) and len(earlier) > (1 if one == last else 2)))
            pairs += [(d, a, *x) for x in {one, last} if earlier]
    assert got == sorted(expected) and links == sorted(pairs)
    assert set(chained) == {(d, p, a, b) for d, a, p, b in pairs}


def test_odd_documents(spark):
    """Very long texts, repeated rows, nulls, ties, clashing columns."""
    from tidemill.llm import passages

    rng = np.random.default_rng(15)
    long = " ".join(f"w{x}" for x in rng.integers(0, 10**9, 60_000))
    quote = " ".join(long.split()[30_000:30_080])
    cycle = " ".join(f"c{i}" for i in range(30)) + " "
    rows = [(1, long), (1, long), (2, quote), (3, quote), (4, None), (None, quote), (5, ""), (6, "a b c"), (7, cycle * 100), (8, cycle * 100)]
    df = spark.createDataFrame([(i, t, "s", 0, "p") for i, t in rows], "doc_id long, text string, seed string, doc int, spans string")
    got = passages.passage_report(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[2].n_removed == 80 == by[3].n_removed and by[1].n_copied >= 1 and by[1].n_removed == 0
    assert by[8].n_removed >= 2900 and by[7].n_removed == 0 and by[4].n_passages == by[5].n_passages == by[6].n_passages == 0
    assert passages.passage_report(df.limit(0)).count() == 0


def test_neighbours_in_a_stream(spark):
    """The same candidates whatever the batches hold, and those that a look at all rows at once gives."""
    from tidemill.llm import neardup

    rng = np.random.default_rng(16)
    rows = []
    for _ in range(60):
        base = rng.integers(0, 3, neardup.LENGTH)
        for _ in range(int(rng.choice([1, 2, 5, 20, 40]))):
            own = np.concatenate([[0], base]).astype(neardup._DIGIT)
            own[1 + int(rng.integers(3, neardup.LENGTH)) :] = rng.integers(0, 4)
            rows.append((len(rows), own.tobytes()))
    df = spark.createDataFrame([(i, bytearray(k)) for i, k in rows], "id long, key binary").coalesce(1)
    keys = sorted((k, i) for i, k in rows)
    numbers = np.frombuffer(b"".join(k for k, _ in keys), neardup._DIGIT).reshape(len(keys), -1)
    lcp = neardup.common_prefix(numbers)
    region = np.concatenate([[0], np.cumsum(lcp < neardup.SHALLOW)])
    few = np.bincount(region) <= neardup.FEW
    few[[0, -1]] = False
    expected = {(keys[i][1], keys[i + 1][1]) for i in np.flatnonzero(lcp >= np.where(few[region[1:]], neardup.SHALLOW, neardup.DEPTH))}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for batch in ("1", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert {(r.a, r.b) for r in neardup.neighbours(df).collect()} == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_curriculum_takes_clashing_names(spark):
    from tidemill.llm import mixing

    rows = [(i, f"s{i % 3}", "a b c " * (i % 5), f"n{i}", f"m{i}", i, f"p{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _none string, _src string, _h int, `_b.x` string")
    got = mixing.curriculum(df)
    assert got.columns == [*df.columns, *mixing.ADDED]
    assert sorted(tuple(r)[:7] for r in got.collect()) == sorted(rows)
    assert mixing.mix(df).columns == df.columns


def test_planted_long_repeats(spark):
    """Of planted passages of 400 bytes or more every copy goes whole, and nothing of texts with shorter ones."""
    from tidemill.llm import repeats

    rng = np.random.default_rng(17)
    fresh = lambda n: "".join(rng.choice(list("abcdefghij klmnop"), n))
    texts, lost = [], []
    for size in (398, 399, 400, 401, 650, 3000):
        passage = fresh(size)
        for k in range(3):  # the characters beside a passage differ from copy to copy
            texts.append(f"{fresh(200 * k + 1)}{k}{passage}{k}{fresh(333)}")
            lost.append(size if size >= 400 else 0)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.cut(repeats.repeated_spans(df)).collect()}
    assert got == {i: (n, int(n > 0)) for i, n in enumerate(lost)}


def test_passages_gather_no_table_on_the_driver(spark):
    """Joins of tables that grow with the input sort both sides, whatever size their files have."""
    from tidemill.llm import passages

    a = spark.range(1000).withColumnRenamed("id", "doc")
    found = spark.createDataFrame([(1, 0, 60)], "doc long, start long, end long")
    rows = a.selectExpr("doc", "10 AS at")
    words = a.selectExpr("doc", "cast('abcd' AS binary) AS hashes")
    asks = a.selectExpr("doc", "array(named_struct('chain', doc, 'side', 0, 'start', 0L, 'end', 2L, 'narrow', false)) AS asks")
    for df in (passages._uncovered(rows, found, ("at",)), passages._parts(words, asks)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert passages._uncovered(rows, found, ("at",)).count() == 999


def test_url_trees_learn_from_every_label(spark):
    """The fit over a table counts every labelled URL, gives what the fit in memory gives, whatever the partitions."""
    from pyspark.sql import functions as F

    from tidemill.llm import urls

    assert not hasattr(urls, "FIT_ROWS")
    n = 30_000
    url = F.concat(F.lit("http://a"), F.col("id").cast("string"), F.when(F.col("id") % 3 == 0, F.lit(".net/es/x")).otherwise(F.lit(".com/en/yyyyy")), F.repeat(F.lit("-7"), (F.col("id") % 11).cast("int")))
    pages = spark.range(n).select(F.col("id").alias("page_id"), url.alias("url"))
    seen = []
    fit, urls.fit_table = urls.fit_table, lambda rows, edges, counts: seen.append((rows, edges, counts)) or fit(rows, edges, counts, trees=2)
    try:
        assert urls.url_verdicts(pages).count() == n
    finally:
        urls.fit_table = fit
    rows, edges, counts = seen[0]
    assert counts.sum() == n and counts[:, 1].sum() == n // 3 and rows.agg(F.sum("n")).first()[0] == n
    (one, scored), (other, _) = fit(rows, edges, counts, trees=4), fit(rows.repartition(7), edges, counts, trees=4)
    assert one == other
    got = rows.toPandas()
    cells = got[[f"b{j}" for j in range(len(edges))]].to_numpy().repeat(got["n"], 0).astype(float)
    y = got["y"].to_numpy().repeat(got["n"]).astype(float)
    local = urls.fit_trees(cells, y, np.where(y > 0, 0.5 * n / y.sum(), 0.5 * n / (n - y.sum())), trees=4)
    apart = np.abs(urls.block_chance(local, cells) - urls.block_chance(one[-1], cells))
    assert np.median(apart) < 1e-4 and apart.mean() < 0.02  # quantiles of bins leave out bins of few rows
    own = scored.toPandas()
    for m, model in enumerate(one):
        assert np.allclose(1 / (1 + np.exp(-own[f"s{m}"])), urls.block_chance(model, own[[f"b{j}" for j in range(len(edges))]].to_numpy()))


@pytest.mark.parametrize("cell", [4, 1 << 14])
def test_every_holder_of_a_seed_is_asked(spark, monkeypatch, cell):
    """A passage with one common seed is found in a document that is neither the first nor the last one with the
    seed, however many there are and however they are dealt."""
    from tidemill.llm import passages
    from tidemill.llm.words import Words

    monkeypatch.setattr(passages, "CELL", cell)
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    own = lambda w: {h: i for i, h in zip(*passages.seeds(Words([" ".join(w).encode()], lower=True))[1:], strict=True)}
    while True:  # four words of five stay, and only one of the k-mers that do is a seed
        a = word(60)
        b = [w if i % 5 < 4 else f"x{i}" for i, w in enumerate(a)]
        common = own(a).keys() & own(b).keys()
        if len(common) == 1 and 10 <= own(a)[min(common)] <= 45:
            break
    at = own(a)[min(common)]
    rows = [(2 * i, word(60) + a[at : at + 4] + word(60)) for i in range(1, 13)] + [(9, word(30) + a + word(30)), (101, word(20) + b + word(20)), (102, word(60) + a[at : at + 4] + word(60))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = [(r.doc, r.partner, r.start, r.end) for r in passages.fuzzy_passages(df).collect()]
    assert [r[:2] for r in got] == [(101, 9)] and got[0][2] <= 20 + at and got[0][3] - got[0][2] >= passages.WORDS


def test_rows_that_meet():
    """Every asking row meets every row of its cell with an earlier document, in small cells and large ones."""
    from tidemill.llm.passages import _met

    rng = np.random.default_rng(9)
    cell = np.repeat(np.arange(6), [1, 5, 700, 2, 300, 40])
    doc = np.concatenate([np.sort(rng.integers(0, max(1, n // 2), n)) for n in np.bincount(cell)])
    asks, odd = rng.random(len(cell)) < 0.6, rng.random(len(cell)) < 0.5
    new = np.concatenate([[True], cell[1:] != cell[:-1]])
    upto = np.maximum.accumulate(np.where(new | np.concatenate([[True], doc[1:] != doc[:-1]]), np.arange(len(cell)), 0))
    met = [np.stack(x, axis=1) for x in _met(new, upto, asks, lambda i, j: odd[i] | odd[j])]
    want = [(i, j) for i in range(len(cell)) for j in range(len(cell)) if cell[i] == cell[j] and doc[j] < doc[i] and asks[i] and (odd[i] or odd[j])]
    assert sorted(map(tuple, np.concatenate(met).tolist())) == sorted(want)


def test_contexts_that_go_on_alike(spark):
    """Places whose words go on from the same place before are told alike, and only those."""
    from tidemill.llm import passages

    words = [f"w{i}" for i in range(200)]
    texts = [words, ["x"] * 7 + words[:150], words[:12] + ["y"] + words[13:]]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc long, text string")
    places = [(1, 10), (2, 30), (3, 40), (4, 120)]
    rows = [(k, d, p + (7 if d == 1 else 0), p + (7 if d == 1 else 0), d != 1) for d in range(3) for k, p in places]
    got = {(r.key, r.doc): r for r in passages._contexts(passages._hashed(df), spark.createDataFrame(rows, "key long, doc long, at int, at2 int, ask boolean")).collect()}
    own = lambda k, d: got[k, d].own
    assert own(1, 0) == own(4, 0) == 0 and own(2, 0) == own(2, 1) != 0 and own(2, 0) != own(2, 2) and own(3, 0) == own(3, 1) == own(3, 2)
    assert got[2, 0].skip == own(2, 0) and got[2, 1].skip == 0 and got[1, 0].leads and not got[3, 0].leads and not got[1, 1].leads
    r = got[1, 0]
    assert (r.left, r.right) == (10, passages.SIDE) and len(r.words) == 2 * passages.SIDE + passages.K and bytes(r.words[:40]) == bytes(40) and r.words[40] > 0


def test_a_long_passage_with_a_middle_holder_is_whole(spark):
    """A long passage is found whole in a document that is neither the first nor the last holder of its seeds."""
    from tidemill.llm import passages

    rng = np.random.default_rng(6)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    a = word(400)
    quotes = lambda: [x for i in range(0, 400, 20) for x in [*a[i : i + 20], *word(40)]]
    rows = [(1, quotes()), (2, word(30) + a + word(30)), (3, quotes()), (4, word(20) + a + word(20))]
    got = passages.passage_report(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got}[4] == 400


def test_filters_before_the_alignment_lose_nothing():
    """Chains of several seeds that are left out hold no passage, and most without one are left out."""
    import pyarrow as pa

    from tidemill.llm.passages import K, align, diagonal, sharing

    rng = np.random.default_rng(31)
    rows = []
    for _ in range(600):
        x, y = (rng.integers(0, 1 << 16, int(rng.integers(70, 260))).astype(np.uint16) for _ in "xy")
        n, i, j = int(rng.integers(20, 70)), *(int(rng.integers(0, 1 + len(t) - 70)) for t in (x, y))
        same = rng.random(n) < rng.choice([0.7, 0.85, 1.0])
        same[:K] = same[-K:] = True
        y[j : j + n][same] = x[i : i + n][same]
        rows.append((1, 0, [i + 500, i + n - K + 500], [j + 90, j + n - K + 90], 500, x.tobytes(), 90, y.tobytes()))
    rows.append((1, 0, [5], [5], 5, b"abcd", 5, b"abc"))
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list("abcdefgh"))
    got = sharing(batch.slice(0, 100)).tolist() + sharing(batch.slice(100)).tolist()
    found = 0
    for (_, _, a, b, xs, x, ys, y), stays in zip(rows[:-1], got, strict=False):
        u, v = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
        matches = [(i - xs, j - ys) for i, j in zip(a, b, strict=True)]
        passage = bool(align(u.tolist(), v.tolist(), matches) or diagonal(u, v, matches))
        assert stays or not passage
        found += passage
    assert got[-1] and 100 < found <= sum(got) < 450


def test_chains_without_a_tree():
    """Matches in order on both sides are chained as the tree chains them, and pairs of documents without wide gaps as
    one chain."""
    from tidemill.llm import passages

    rng = np.random.default_rng(32)
    for _ in range(300):
        n = int(rng.integers(2, 25))
        a, b = (np.cumsum(rng.integers(1, rng.choice([5, 60, 200]), n)) for _ in "ab")
        score, before = [], []
        for i in range(n):
            own = [(score[j] - passages.GAP * (a[i] - a[j] + b[i] - b[j]), j) for j in range(i)]
            best = max(own, default=(0.0, -1))
            score.append(passages.K + max(best[0], 0.0))
            before.append(best[1] if best[0] > 1e-9 else -1)
        got = passages.chain(a, b)
        assert sorted(i for own in got for i in own) == list(range(n))
        assert all(before[y] == x for own in got for x, y in zip(own, own[1:]))
        assert score[got[0][-1]] > max(score) - 1e-6 and before[got[0][0]] == -1
        if (passages.GAP * (np.diff(a) + np.diff(b)) < passages.K).all():
            assert got == [list(range(n))]


def test_words_compared_by_their_bits():
    """Equal words are never counted as different, so that no pair of places is lost; in large cells every pair is met."""
    from tidemill.llm.passages import _bits, _met, _unlike

    rng = np.random.default_rng(33)
    x, y = rng.integers(0, 256, (40, 104)).astype(np.uint8), rng.integers(0, 256, (700, 104)).astype(np.uint8)
    y[::7, 20:70] = x[0, 20:70]
    unlike = _unlike(_bits(x), _bits(y))
    low = (x[:, None] & 15) != (y[None] & 15)
    assert (unlike == low.sum(axis=2)).all() and (unlike <= (x[:, None] != y[None]).sum(axis=2)).all()
    new = np.arange(700) == 0
    odd = rng.random((700, 700)) < 0.5
    for share in (0.01, 0.9):
        near = odd & (rng.random((700, 700)) < share)
        met = [np.stack(m, axis=1) for m in _met(new, np.arange(700), np.ones(700, bool), lambda i, j: odd[i, j], lambda i, j: near[i, j])]
        pairs = [(i, j) for i in range(700) for j in range(i) if (near if i >= 256 else odd)[i, j]]
        assert sorted(map(tuple, np.concatenate(met).tolist())) == sorted(pairs)


def test_sides_of_chains_in_a_stream(spark):
    """Both sides' words meet their chain's row wherever batches end, and where a side stands there twice."""
    from tidemill.llm import passages

    rng = np.random.default_rng(34)
    rows, want = [], []
    for c in range(60):
        x = rng.integers(1, 255, 104).astype(np.uint8)
        rows.append((c, -1, c + 1, 0, [50], [50], None, None))
        sides = [(c, 0, None, None, None, None, 0, x.tobytes()), (c, 1, None, None, None, None, 0, x.tobytes())]
        rows += sides[: 1 if c % 5 == 4 else 2] + sides * (c % 3 == 1)
        if c % 5 != 4 or c % 3 == 1:
            want.append((c + 1, 0, 104, 0, 0, 104))
    df = spark.createDataFrame(rows, "chain long, side int, doc long, partner long, a array<long>, b array<long>, start long, words binary").repartition(3)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in (1, 2, 7, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            assert sorted(tuple(r) for r in passages._aligned(df).collect()) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_runs_of_words_beyond_a_common_line():
    """Pairs of one seed that make a passage share a run of words beyond a line that all holders have; the others are few."""
    from tidemill.llm.passages import K, SIDE, _met, _runs, diagonal

    rng = np.random.default_rng(31)
    words = rng.integers(1, 255, (600, 2 * SIDE + K)).astype(np.uint8)
    words[:, SIDE - 5 : SIDE + K + 4] = words[0, SIDE - 5 : SIDE + K + 4]
    want = set()
    for i in range(300, 340):  # 50 words of an earlier row, 10 of them changed
        start = int(rng.integers(4, SIDE - 4))
        words[i, start : start + 50] = words[i - 300, start : start + 50]
        for k in rng.choice([x for x in range(start + 1, start + 49) if not SIDE - 5 <= x < SIDE + K + 4], 10, replace=False):
            words[i, k] = words[i, k] % 254 + 1
        if diagonal(words[i], words[i - 300], [(SIDE, SIDE)]):
            want.add((i, i - 300))
    words[340] = words[341] = 7  # one word over and over
    assert len(want) == 40
    heavy, x, y = next(iter(_runs(words, words)))
    near = {(i, j) for i, j in zip(x.tolist(), y.tolist()) if j < i}
    assert want <= near and len(near) < 1000 and heavy.tolist() == [340, 341]  # of 180,000 pairs
    calls = []
    fit = lambda i, j: calls.append(np.size(i)) or np.ones(np.broadcast(i, j).shape, bool)
    met = _met(np.arange(600) == 0, np.arange(600), np.ones(600, bool), fit, None, lambda i, j: _runs(words[i], words[j]))
    got = {(i, j) for m in met for i, j in zip(*(c.tolist() for c in m)) if i >= 256}
    assert got == {(i, j) for i, j in near if i >= 256} | {(i, j) for i in (340, 341) for j in range(i)}


def test_places_in_common(spark):
    from tidemill.llm.passages import _in_common

    rng = np.random.default_rng(32)
    rows = sorted({(int(rng.integers(9)), int(rng.integers(12)), int(rng.integers(40))) for _ in range(200)})
    both = [(d, p) for d in range(12) for p in range(d) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "key long, doc long, at int")
    got = sorted(tuple(r) for r in _in_common(df, spark.createDataFrame(both, "doc long, partner long")).collect())
    assert got == sorted((d, a, p, b) for d, p in both for k, x, a in rows if x == d for q, y, b in rows if y == p and q == k)
