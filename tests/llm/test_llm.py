"""Each operator against brute force, on a supplied table and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, size string, _norm string"


def low(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 701}x{i}" for i in range(30_000))
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, line), (4, line), (4, line), (5, line.replace(" ", "  ")), (6, long), (7, long + " end"), (8, "a b"), (9, "A B"), (10, "a  b c"), (None, None), (11, "é" * 900), (12, "x" * 1200), (13, "日本語 " * 300)]
    return spark.createDataFrame([(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", "q", "z") for k, (i, t) in enumerate(rows)], SCHEMA)


def collected(df):
    return [r.asDict() for r in df.collect()]


def components(texts, percent):
    sets = []
    for x in texts:
        w = WORD.findall(low(x))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    count = collections.Counter()
    inverted = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    for own in inverted.values():
        for a in range(len(own)):
            for b in range(a):
                count[own[b], own[a]] += 1
    for (a, b), c in count.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("limit", [4096, 2])
def test_near_groups(spark, docs, limit):
    from tidemill.llm import neardup

    rows = sorted(docs.select("doc_id", "text").collect())
    sizes, roots = components([r.text for r in rows], 85)
    expected = {r.doc_id: (n, rows[k].doc_id) for r, n, k in zip(rows, sizes, roots, strict=True)}
    got = collected(neardup.near_groups(docs, limit=limit))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_near_groups_odd(spark, odd):
    from tidemill.llm import neardup

    got = collected(neardup.near_groups(odd))
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[5]["component_id"] == 4 and by[7]["component_id"] == 6 and by[9]["component_id"] == 8
    assert by[1]["n_shingles"] == by[3]["n_shingles"] == 0 and by[2]["component_id"] == 2
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    kept = neardup.drop_near(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 1, 2, 3, 4, 6, 8, 10}
    assert neardup.near_groups(odd.limit(0)).count() == 0


def test_near_group_of_variants(spark):
    """A dense family: links follow brute force whatever the region sizes."""
    from tidemill.llm import neardup

    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        for p in rng.integers(0, 120, i % 5):
            w[p] = f"v{i}_{p}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limit in (4096, 8):
        got = {r.doc_id: r.component_id for r in neardup.near_groups(df, limit=limit).collect()}
        assert got == dict(enumerate(components(texts, 85)[1]))


def test_near_pairs_inside_one_large_region(spark):
    """Pairs of a family that are linked with nothing else, the family's first document included."""
    from tidemill.llm import neardup

    base = [f"w{i}" for i in range(3000)]
    texts = []
    for g in range(24):
        own = [*base[: 100 * g + 50], f"g{g}", *base[100 * g + 51 :]]
        texts += [" ".join(own), " ".join([*own[:-1], "end"])]
    texts = texts[::2] + texts[1::2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_groups(df, percent=99.9, limit=6).collect()}
    assert got == {i: i % 24 for i in range(48)} == dict(enumerate(components(texts, 99.9)[1]))


def test_near_pairs_at_the_threshold_in_large_clusters(spark):
    """A limit under the size of every cluster loses no pair."""
    from tidemill.llm import neardup

    rng = np.random.default_rng(15)
    texts = []
    for g in range(60):
        w = [f"g{g}_{i}" for i in range(400)]
        texts += [" ".join(w), " ".join(["x" if i % 44 == 20 else x for i, x in enumerate(w)])]
    assert components(texts, 79)[1] == [i - i % 2 for i in range(120)]
    df = spark.createDataFrame([(i, texts[i]) for i in rng.permutation(120).tolist()], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_groups(df, percent=79, limit=1).collect()}
    assert got == {i: i - i % 2 for i in range(120)}


def test_exact(spark, odd):
    from tidemill.llm import exact

    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i is None, i or 0))
    got = collected(exact.exact_groups(odd))
    expected = []
    for i, t in rows:
        own = groups[re.sub(r"[\x20\x09-\x0D]", "", t)]
        best = min(own)
        expected.append((i, None if best[1] else best[2], len(own), hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()))
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=key) == sorted(expected, key=key)
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact.drop_exact(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact.exact_groups(odd.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [512, 3])
def test_equal_texts_are_adjacent(spark, piece):
    """In content order equal texts stand side by side, also those that are sorted in pieces."""
    from tidemill.llm import exact

    rows = [(i, ["hot text", f"one {i}", "pair %d" % (i // 2)][i % 3] + " " * (i % 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = exact.stage(exact.keyed(df.select("doc_id", F.char_length("text").cast("long").alias("_n"), exact.without_space(F.col("text")).alias("_norm")), F.col("_norm")), "t")
    seen = exact.content_order(keyed, "doc_id", F.col("_norm"), piece).select("_norm", "_rn", F.monotonically_increasing_id().alias("at"))
    seen = exact.stage(seen, "seen").orderBy("at").collect()
    assert len(seen) == 300
    runs = [r._norm for k, r in enumerate(seen) if not k or r._norm != seen[k - 1]._norm]
    assert len(runs) == len(set(runs))
    got = {r.doc_id: r for r in exact.exact_groups(df, piece=piece).collect()}
    assert {r.keep_id for i, r in got.items() if i % 3 == 0} == {3} and all(r.group_size == 100 for i, r in got.items() if i % 3 == 0)
    assert sum(r.kept for r in got.values()) == len(runs) == exact.drop_exact(df, piece=piece).count()


def test_signature_orders(spark):
    """Candidates are neighbours in the sorted orders whose common prefix is deep enough, across partitions too."""
    from tidemill.llm import neardup

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(200)]
    made = neardup.signatures(sets)
    rows = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(made)], "id long, signatures binary")
    got = {tuple(sorted((r.a, r.b))) for r in neardup.neighbours(neardup.orders(rows)).collect()}
    least = set()
    for t in range(neardup.TREES):
        order = sorted(range(200), key=lambda i: (made[i, t].tobytes(), i))
        for x, y in zip(order, order[1:]):
            n = int(np.cumprod(made[x, t, 1:] == made[y, t, 1:]).sum())
            if n >= neardup.DEPTH:
                least.add(tuple(sorted((x, y))))
            assert n >= neardup.SHALLOW or tuple(sorted((x, y))) not in got or any((made[x, u, 1:5] == made[y, u, 1:5]).all() for u in range(neardup.TREES))
    assert least and least <= got
    assert neardup.neighbours(neardup.orders(rows.limit(0))).count() == 0


def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return low(host), slash + path


def test_urls(spark):
    from tidemill.llm import urls

    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", F.lit(1).alias("f_length"), F.lit("h").alias("host"))
    extra = [(1000, None), (1001, ""), (1002, "nothing"), (1003, "http://WWW.Example.COM/en/x?y"), (1004, "http://a.net"), (1005, "x://example.com/en/"), (1006, "http://notcom/"), (1007, "http://y.com?a/b"), (1008, "http://a.com/" + "é1" * 5000)]
    pages = pages.unionByName(spark.createDataFrame(extra, "page_id long, url string"), allowMissingColumns=True)
    got = {r.page_id: r for r in urls.url_verdicts(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        host, path = _host_path(r.url)
        fits = [x for x in urls.RULES if (host == x[0].partition("/")[0] or host.endswith("." + x[0].partition("/")[0])) and path.startswith("/" + x[0].partition("/")[2])]
        best = max(fits, key=lambda x: len(x[0]), default=(None, None))
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, best[0])
        assert g.verdict in ("allow", "block") and (best[1] is None or g.verdict == best[1])
    assert urls.url_verdicts(pages.limit(0)).count() == 0


def test_url_verdicts_without_rules(spark):
    """Suffixes of rules do not decide other URLs, and the trees leave most URLs alone."""
    from tidemill.llm import urls

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    got = urls.url_verdicts(pages)
    said = F.when(F.col("rule").isin("net/es/", "net/fr/", "example.com/en/"), 1).when(F.col("rule").isNotNull(), 0)
    rows = got.withColumn("y", said).where("y is not null").collect()
    assert len(rows) > 100 and all(0 <= r.block_probability <= 1 and r.verdict == ("block" if r.y else "allow") for r in rows)
    rest = got.where("rule is null")
    assert rest.where("verdict = 'block'").count() < 0.3 * rest.count()
    net = [r.verdict for r in got.where("rule is null and host like '%.net'").collect()]
    assert net and net.count("block") < len(net), (net.count("block"), len(net))


def test_block_chance_is_the_tree_score(spark):
    from tidemill.llm import urls

    rng = np.random.default_rng(2)
    x = rng.random((300, len(urls.FEATURES)))
    model = urls.fit_trees(x, (x[:, 1] > 0.4).astype(float), np.ones(300))
    got = spark.createDataFrame(x.tolist(), list(urls.FEATURES)).select((1 / (1 + F.exp(-urls.tree_score(model)))).alias("p")).collect()
    assert np.allclose([r.p for r in got], urls.block_chance(model, x))


def test_url_trees_held_out():
    from tidemill.llm import urls

    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = urls.fit_trees(x[:3000], y[:3000], np.ones(3000))

    def walk(n, row):
        while isinstance(n, tuple):
            n = n[2] if row[n[0]] <= n[1] else n[3]
        return n

    said = [model["base"] + sum(walk(t, row) for t in model["trees"]) > 0 for row in x[3000:]]
    assert np.mean(said == (y[3000:] > 0)) > 0.95


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mixing(request, which):
    from tidemill.llm import mixing

    df = request.getfixturevalue(which)
    got = collected(mixing.curriculum(df))
    assert len(got) == df.count()
    sizes = collections.Counter()
    for r in df.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        weight = sum(k % 3 + 1 for k, s in enumerate(order) if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * (k % 3 + 1) / weight for k, s in enumerate(order)}
        more = {s for s in order if target[s] > 3 * sizes[s]}
        if not more - full:
            break
        full |= more
    taken, most = collections.Counter(), collections.Counter()
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert len(r["positions"]) <= 3 and all(0 <= p <= 1 for p in r["positions"])
        taken[s] += r["size"] * len(r["positions"])
        most[s] = max(most[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6 for s in order)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(len(r["positions"]) for r in got)


def test_mixing_agrees_again(docs):
    from tidemill.llm import mixing

    once, again = (sorted((r["doc_id"], tuple(r["positions"])) for r in collected(mixing.curriculum(x))) for x in (docs, docs.repartition(7)))
    assert once == again and mixing.curriculum(docs.limit(0)).count() == 0


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_quality(request, spark, which):
    from tidemill.llm import quality

    df = request.getfixturevalue(which)
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in collected(quality.quality_rules(df, spark.read.parquet(f"{DATA}/labels.parquet"))))
    expected = []
    for r in df.collect():
        x = r.text or ""
        w, seen, dup, covered = WORD.findall(x), set(), 0, set()
        for line in x.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        count = collections.Counter(zip(w, w[1:], w[2:], w[3:], w[4:]))
        for i in range(len(w) - 4):
            if count[tuple(w[i : i + 5])] > 1:
                covered.update(range(i, i + 5))
        expected.append((str(r.doc_id), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    assert got == sorted(expected)


def test_quality_held_out(spark):
    """Trusted and poor documents that the fit did not see are told apart."""
    from tidemill.llm import quality

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_rules(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    share = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("share")).collect()}
    assert share[1] > 0.97 and share[0] < 0.3


def test_passages(spark):
    from tidemill.llm import passages

    rng = np.random.default_rng(2)
    word = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    shared = word(70)
    fuzzy = list(shared)
    fuzzy[20], fuzzy[45] = "zz", "yy"
    del fuzzy[60]
    a, b, c, d = word(40) + shared + word(30), word(90) + shared + word(5), word(10) + fuzzy + word(80), word(200)
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join(d)), (5, None), (None, " ".join(a)), (6, ""), (7, " ".join(shared[:30] + d[:20]))]
    got = {r.doc_id: r for r in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert [(s.start, s.end) for s in got[2].spans] == [(90, 160)] and got[2].n_removed == 70
    assert got[3].n_passages >= 1 and 65 <= got[3].n_removed <= 72
    assert got[1].n_copied >= 1 and got[1].n_passages == 0
    assert all(got[i].n_passages == 0 for i in (4, 5, None, 6, 7))
    assert passages.passage_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_passages_behind_quotes(spark):
    """The first and the last earlier document of every seed hold quotes too short for a passage."""
    from tidemill.llm import passages

    rng = np.random.default_rng(12)
    word = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    rows, full = [], {}
    for case in range(4):
        shared = word(80)
        for own in (shared[:45], shared[35:], shared, shared[:45], shared[35:], shared):
            rows.append((len(rows), " ".join(word(70) + own + word(70))))
        full[len(rows) - 1] = len(rows) - 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end, s.partner) for s in r.spans or []] for r in passages.passage_report(df).collect()}
    assert got == {i: [(70, 150, full[i])] if i in full else [] for i, _ in rows}


def test_passages_at_the_threshold(spark):
    """Passages with every 8th or every 5th word changed, and with a fifth of the words changed anywhere."""
    from tidemill.llm import passages
    from tidemill.llm.words import Words

    rng = np.random.default_rng(13)
    word = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    rows = []
    for step in [8] * 5 + [5] * 5:
        shared = word(100)
        other = [f"u{x}" if i % step == step - 1 else x for i, x in enumerate(shared)]
        rows += [(len(rows), " ".join(word(50) + shared + word(50))), (len(rows) + 1, " ".join(word(60) + other + word(60)))]
    got = {r.doc_id: r.n_removed for r in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] >= 90 if i % 2 else got[i] == 0 for i in got)
    hit = 0
    for _ in range(300):
        x = word(50)
        y = list(x)
        for i in rng.choice(50, 10, replace=False):
            y[i] = "zz"
        doc, _, h = passages.seeds(Words([" ".join(x).encode(), " ".join(y).encode()], lower=True))
        hit += bool(set(h[doc == 0].tolist()) & set(h[doc == 1].tolist()))
    assert hit >= 0.96 * 300


def test_passages_that_stand_twice(spark):
    from tidemill.llm import passages

    rng = np.random.default_rng(14)
    word = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    shared = word(80)
    rows = [(1, word(20) + shared + word(20)), (2, shared + word(80) + shared), (3, shared[:45] + word(90) + shared[:70] + word(9)), (4, word(60) + ["a", "b"] * 60 + word(5)), (5, word(9) + ["a", "b"] * 60)]
    got = {r.doc_id: r for r in passages.passage_report(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    assert [(s.start, s.end) for s in got[2].spans] == [(0, 80), (160, 240)] and got[2].n_passages == 2 and got[2].n_removed == 160
    assert {(s.start, s.end) for s in got[3].spans} == {(135, 205)} and got[3].n_removed == 70
    assert got[5].n_removed == 120 and got[1].n_passages == got[4].n_passages == 0


def test_chain_matches_brute_force():
    from tidemill.llm import passages

    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 12))
        a, b = rng.integers(0, 40, n), rng.integers(0, 40, n)
        score = {}
        for i in sorted(range(n), key=lambda i: (a[i], b[i])):
            score[i] = passages.K + max([0.0, *(score[j] - passages.GAP * (a[i] - a[j] + b[i] - b[j]) for j in score if a[j] < a[i] and b[j] < b[i])])
        first = passages.chain(a, b)[0]
        own = sum(passages.K for _ in first) - sum(passages.GAP * (a[y] - a[x] + b[y] - b[x]) for x, y in zip(first, first[1:]))
        assert own == pytest.approx(max(score.values()))


def test_previous_factors_match_brute_force():
    from tidemill.llm.repeats import previous_factors, previous_smaller, suffix_order

    rng = np.random.default_rng(7)
    for length, letters, size in [(1, 2, 40), (5, 2, 300), (8, 3, 200), (20, 2, 700), (100, 1, 500), (60, 250, 900)]:
        buf = rng.integers(0, letters, size).astype(np.uint8)
        buf[size // 2 : size // 2 + size // 3] = buf[: size // 3]
        for at in (np.arange(size - length + 1), np.flatnonzero(rng.random(size - length + 1) < 0.5)):
            keys = [bytes(buf[i : i + length]) for i in at]
            order, rank = suffix_order(buf, at, length)
            assert order.tolist() == sorted(range(len(at)), key=lambda i: (keys[i], i))
            assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i, j in zip(order, order[1:]))
            factor = previous_factors(buf, at, length)
            for i, f in enumerate(factor.tolist()):
                assert (f >= 0) == (keys[i] in keys[:i]) and (f < 0 or (f < i and keys[f] == keys[i]))
            assert previous_smaller(order).tolist() == [max((j for j in range(i) if order[j] < order[i]), default=-1) for i in range(len(order))]


@pytest.mark.parametrize("limit", [20_000, 0])
@pytest.mark.parametrize("which", ["docs", "odd"])
def test_long_repeats(request, which, limit):
    from tidemill.llm import repeats

    df = request.getfixturevalue(which)
    rows = [(r.doc_id, (r.text or "").encode()) for r in df.collect()]
    count = collections.Counter(x[i : i + 400] for _, x in rows for i in range(len(x) - 399))
    expected = []
    for d, x in rows:
        mark = bytearray(len(x))
        for i in range(len(x) - 399):
            if count[x[i : i + 400]] > 1:
                mark[i : i + 400] = b"\1" * 400
        kept = bytes(y for y, m in zip(x, mark) if not m)
        spans = sum(1 for i in range(len(mark)) if mark[i] and (not i or not mark[i - 1]))
        expected.append((str(d), len(x), len(x) - len(kept), spans, kept))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.cut(repeats.repeated_spans(df, limit=limit)).collect())
    assert got == sorted(expected)
    assert repeats.repeated_spans(df.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    from tidemill.llm import toxicity

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    labels = toxicity.with_poor(labels)
    got = toxicity.toxicity(docs.join(labels, "doc_id", "left_semi"), labels.where("doc_id % 2 = 0")).drop("text", "toxic").join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = [(r.p_toxic >= toxicity.THRESHOLD, r.toxic == 1) for r in got.collect()]
    assert np.mean([p for p, y in rows if y]) > 0.85 and np.mean([p for p, y in rows if not y]) < 0.02


def test_toxicity_odd(spark, odd):
    from tidemill.llm import toxicity

    labels = spark.createDataFrame([(1, 1, 0), (4, 0, None), (6, 0, 1), (6, 0, 0), (None, 1, 1)], "doc_id long, poor int, toxic int")
    got = toxicity.toxicity(odd.withColumn("toxic", F.lit("x")), labels)
    assert got.count() == odd.count() and got.schema["toxic"].dataType.simpleString() == "boolean"
    assert toxicity.toxicity(odd, labels.limit(0)).where("toxic").count() == 0
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


@pytest.fixture(scope="module")
def model_file():
    public = pytest.importorskip("public_tokenizers")
    return public.path("piece_bpe_32k.model")


def test_pieces_match_library(spark, docs, odd, model_file):
    import sentencepiece

    from tidemill.llm import pieces

    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    for df in (docs, odd):
        texts = {(r.doc_id, r.text) for r in df.collect()}
        got = pieces.encode(df.withColumn("body", F.col("text")), model_file)
        for r in got.collect():
            assert r.ids == library.encode(r.body or "") and r.n_tokens == len(r.ids) and r.round_trip
        back = pieces.decode(got.drop("text"), model_file)
        assert {(r.doc_id, r.text) for r in back.collect()} == {(i, t or "") for i, t in texts}
    assert pieces.encode(docs.limit(0), model_file).count() == 0


def test_pieces_random_and_viterbi(model_file):
    import random

    import sentencepiece

    from tidemill.llm import pieces

    raw = open(model_file, "rb").read()
    random.seed(1)
    alphabet = "ab the ▁\n\t  é日本語ﬁ😀<0x41>0123'\x00 "
    texts = ["", " ", "the" * 100, "日本" * 80, " " * 90] + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(500)]
    library = sentencepiece.SentencePieceProcessor(model_proto=raw)
    made = pieces.Encoder(model_file)
    assert [np.frombuffer(x, "<i4").tolist() for x in made.encode(texts)] == [library.encode(x) for x in texts]
    # the same pieces as a unigram model: single words, whose scores the library adds without rounding
    at = raw.index(b"\x18\x02\x20")  # trainer_spec: model_type BPE, then vocab_size
    unigram = raw[:at] + b"\x18\x01" + raw[at + 2 :]
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram)
    model = pieces.Model(unigram)
    assert model.kind == pieces.UNIGRAM
    words = sorted({"".join(random.choice("theandiorsé日😀") for _ in range(random.randint(1, 9))) for _ in range(400)})
    for w in words:
        got = b"".join(model.encode_words(model.words(w)).values()) if len(model.words(w)) == 1 else None
        assert got is None or np.frombuffer(got, "<i4").tolist() == library.encode(w)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_token_files(request, which):
    from tokenizers import Tokenizer

    from tidemill.llm import tokenfile

    public = pytest.importorskip("public_tokenizers")
    df = request.getfixturevalue(which)
    file = public.path("byte_bpe_50k.json")
    manifest = tokenfile.write_tokens(df, tokenfile.tokens_folder(df.sparkSession), file, end_id=2)
    got = {}
    for r in tokenfile.read_tokens(manifest).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    tokenizer, place = Tokenizer.from_file(file), 0
    rows = df.collect()
    assert sum(map(len, got.values())) == len(rows)
    texts = collections.defaultdict(list)
    for r in rows:
        texts[r.doc_id].append(r.text or "")
    for i in sorted(texts, key=lambda i: (i is None, i or 0)):
        raws = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for t in texts[i]]
        assert sorted((len(x) // 4, zlib.crc32(x)) for x in raws) == sorted(x[1:] for x in got[i])
        assert min(x[0] for x in got[i]) == place
        place += sum(len(x) // 4 for x in raws)
    path = manifest.first()["path"]
    fs, name = tokenfile.open_path(path)
    with fs.open_input_file(name) as f:
        shard = tokenfile.Shard(f)
        some = None if shard.index[-1, 1] else shard.index[-1, 0].item()
        own = list(shard.documents({some}))
        assert own and all(d == some for d, _, _ in own)
    assert tokenfile.read_tokens(tokenfile.write_tokens(df.limit(0), tokenfile.tokens_folder(df.sparkSession), file, 2)).count() == 0


def test_damaged_frame_is_seen(tmp_path):
    from tidemill.llm import tokenfile

    with open(tmp_path / "x", "wb") as f:
        tokenfile.write_shard(f, [(i, np.arange(500, dtype="<u4").tobytes()) for i in range(5)], frame_ids=600)
    raw = bytearray((tmp_path / "x").read_bytes())
    raw[30] ^= 255
    (tmp_path / "x").write_bytes(raw)
    fs, name = tokenfile.open_path(f"file://{tmp_path}/x")
    with fs.open_input_file(name) as f, pytest.raises(Exception):
        list(tokenfile.Shard(f).documents())


def test_pieces_of_text_match_library():
    import random

    from tokenizers import Tokenizer

    from tidemill.llm import tokenfile

    public = pytest.importorskip("public_tokenizers")
    file = public.path("byte_bpe_50k.json")
    random.seed(3)
    parts = ["a", "b", "the", "'s", "'", "'re", "’", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "é", "Ω", "中", "٣", "²", "1", "23", "###", "...", ",", "-", "_", "<|endoftext|>", "<|", "x\u0301", "İ", "\x1c", "\x85", "\r\n", "😀", "×", "ɏ", "ɐ", "`", "\\", "\x00"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 25))) for _ in range(5000)]
    made, tokenizer = tokenfile.PieceEncoder(file), Tokenizer.from_file(file)
    assert made.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_components(spark):
    from tidemill.llm.components import components

    edges = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 13), (13, 14), (14, 10), (20, 20), (7, None)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[3] == 1 and got[14] == 10 and got[130] == 100 and got[20] == 20
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    """Each stage against plain Python on the rows that the stage before it gave."""
    import corpus_pipeline as P

    from tidemill.llm.shared import stage

    docs, seen = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, step in P.STAGES:
        out = stage(step(spark, docs, DATA), name)
        seen[name] = (docs, out)
        docs = out
    for name in list(seen)[:-1]:
        assert seen[name][1].columns == seen[name][0].columns
    before, after = seen["exact_dedup"]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert sorted(norm(r.text) for r in after.collect()) == sorted({norm(r.text) for r in before.collect()})
    before, after = seen["near_dedup"]
    rows = sorted(before.select("doc_id", "text").collect())
    roots = components([r.text for r in rows], 80)[1]
    assert {r.doc_id for r in after.collect()} == {rows[k].doc_id for k in roots}
    before, after = seen["mix_sources"]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    assert seen["encode"][1].count() == seen["encode"][0].count() and seen["encode"][1].where("not round_trip").count() == 0
    assert P.run(spark, DATA).count() == seen["encode"][1].count()


def test_pipeline_odd(spark, odd):
    import corpus_pipeline as P

    from tidemill.llm.shared import stage

    docs = odd.withColumn("toxic", F.lit("kept as it is"))
    for name, step in P.STAGES:
        columns = docs.columns
        docs = stage(step(spark, docs, DATA), name)
        if name != "encode":
            assert docs.columns == columns and docs.where("toxic <> 'kept as it is'").isEmpty()
    assert docs.count() > 0
    empty = odd.limit(0)
    for name, step in P.STAGES:
        empty = stage(step(spark, empty, DATA), name)
        assert empty.count() == 0


def test_sieve_loses_no_wanted_row(spark):
    from tidemill.llm.shared import sieve

    rows = spark.range(50_000).withColumn("_b", F.lit("x")).unionByName(spark.createDataFrame([(None, "y"), (7, "z")], "id long, _b string"))
    wanted = spark.range(50_000).where("id % 50 = 7")
    got = sieve(rows, wanted, "id")
    ids = [r.id for r in got.collect()]
    assert got.columns == rows.columns and set(range(7, 50_000, 50)) <= set(ids) and None not in ids
    assert ids.count(7) == 2 and len(ids) < 6_000
    assert sieve(rows, wanted, "id", most=999).count() == 50_002
    assert sieve(rows, wanted.limit(0), "id").count() == 0
