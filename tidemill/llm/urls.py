"""URL filters: host and path rules, then gradient-boosted trees on lexical features."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lower_ascii, stage

#: (rule, verdict); fixed by the contract.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Of the labelled URLs that rules allow, the trees would block so many out of fold, at most.
MOST_WRONG = 0.05
#: Suffix statistics of a labelled row come from the rows of the other folds.
FOLDS = 5
#: Trees, their depth, the weight of a tree, and bins of a feature.
TREES, DEPTH, RATE, BINS = 24, 3, 0.3, 32
#: Gradients are summed as whole numbers of this part, so that sums don't depend on their order.
UNIT = 1 << 20
#: Trees whose values are added up in a plan before the scores are written.
WRITE = 2
FEATURES = ("f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_labels", "f_host", "f_suffix")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without '://'."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    bare = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.regexp_extract(bare, "^([^/]*)", 1)
    return lower_ascii(host), F.substring(bare, F.length(host) + 1, F.length(bare))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls where none does.  Rules are literals of the plan."""
    fits_host = lambda h: (host == F.lit(h)) | F.endswith(host, F.lit("." + h))
    name = verdict = None
    for rule, said in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, slash, p = rule.partition("/")
        fits = fits_host(h) & F.startswith(path, F.lit(slash + p))
        name = F.when(fits, F.lit(rule)) if name is None else name.when(fits, F.lit(rule))
        verdict = F.when(fits, F.lit(said)) if verdict is None else verdict.when(fits, F.lit(said))
    return (F.lit(None).cast("string") if name is None else name), (F.lit(None).cast("string") if verdict is None else verdict)


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits, 0 for empty text: one fold over the sorted characters."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))
    term = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))
    step = lambda a, c: F.when(a.c == c, F.struct(c.alias("c"), (a.n + 1.0).alias("n"), a.s.alias("s"))).otherwise(F.struct(c.alias("c"), F.lit(1.0).alias("n"), (a.s + term(a.n)).alias("s")))
    total = F.size(chars).cast("double")
    return F.when(total > 0, F.log2(total) - F.aggregate(chars, start, step, lambda a: a.s + term(a.n)) / total).otherwise(F.lit(0.0))


def lexical(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host, path, the last host label f_tail and the lexical features but f_suffix."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = parts(F.col(url_col))
    rows = pages.withColumns({"host": host, "path": path})
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
    return rows.withColumns({
        "f_length": F.length(url).cast("double"), "f_depth": count(F.col("path"), "/").cast("double"),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)), "f_entropy": entropy(url),
        "f_params": count(url, "=").cast("double"), "f_hyphens": count(F.col("host"), "-").cast("double"),
        "f_labels": count(F.col("host"), ".").cast("double"), "f_host": F.length("host").cast("double"),
        "f_tail": F.substring_index("host", ".", -1),
    })


def best_split(g: np.ndarray, h: np.ndarray, bins: list[int]) -> tuple[int, int] | None:
    """Feature and last bin of the left side with the highest gain; g and h are sums by feature and bin."""
    best = (1e-6, None)
    for j, n in enumerate(bins):
        gs, hs = g[j].sum(), h[j].sum()
        gl, hl = np.cumsum(g[j, :n])[:-1], np.cumsum(h[j, :n])[:-1]
        gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
        if len(gain) and gain.max() > best[0]:
            best = (gain.max(), (j, int(gain.argmax())))
    return best[1]


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> dict:
    """Second-order boosting of the weighted logistic loss with histogram splits, for labels in memory.
    Nodes are (feature, threshold, left, right) or leaf values."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1) if len(x) else np.zeros(x.shape, int)
    base = _base(weight[y > 0].sum(), weight[y <= 0].sum())
    score = np.full(len(y), base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int):
        split = None
        if left and len(rows) > 1:
            sums = (np.stack([np.bincount(binned[rows, j], w[rows], bins) for j in range(len(edges))]) for w in (g, h))
            split = best_split(*sums, [len(e) + 1 for e in edges])
        if split is None:
            value = -rate * g[rows].sum() / (h[rows].sum() + 1)
            score[rows] += value
            return float(value)
        j, b = split
        low = binned[rows, j] <= b
        return (j, float(edges[j][b]), grow(rows[low], g, h, left - 1), grow(rows[~low], g, h, left - 1))

    out = []
    for _ in range(trees if len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        out.append(grow(np.arange(len(y)), weight * (p - y), weight * p * (1 - p), depth))
    return {"base": base, "trees": out}


def _base(blocked: float, allowed: float) -> float:
    """The log odds of the classes' weights, held within 1 in 1,000."""
    share = float(np.clip(blocked / (blocked + allowed), 1e-3, 1 - 1e-3)) if blocked + allowed else 1e-3
    return math.log(share / (1 - share))


def _grid(c: Column) -> Column:
    """A value to nine significant bits, rounded down: whole numbers below 512 stay."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(c)) - 8)
    return F.when(c > 0, F.floor(c / step) * step).otherwise(F.lit(0.0))


def _edges(rows: DataFrame) -> list[np.ndarray]:
    """Upper ends of each feature's bins: its quantiles over all rows, from counts of values on a grid."""
    values = rows.select(F.posexplode(F.array(*(_grid(F.col(c)) for c in FEATURES))).alias("j", "v")).groupBy("j", "v").agg(F.count("*").alias("n"))
    of: dict[int, list[tuple[float, int]]] = {}
    for r in values.collect():
        of.setdefault(r["j"], []).append((r["v"], r["n"]))
    out = []
    for j in range(len(FEATURES)):
        v, n = (np.array(c) for c in zip(*sorted(of[j]), strict=True)) if j in of else (np.zeros(0), np.zeros(0, int))
        ends = np.cumsum(n)
        at = np.arange(1, BINS) * (int(ends[-1]) if len(ends) else 0) // BINS
        out.append(np.unique(v[np.searchsorted(ends, at, "right")]) if len(v) else v)
    return out


def _binned(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """b0, b1, ... (the bin of each feature), fold, y, n: rows that fall into the same bins are one, counted."""
    below = lambda e, c: F.size(F.filter(F.array(*(F.lit(float(v)) for v in e)), lambda v: v < F.col(c)))
    bins = [below(e, c) if len(e) else F.lit(0) for e, c in zip(edges, FEATURES, strict=True)]
    names = [f"b{j}" for j in range(len(bins))]
    return rows.select(*(b.alias(c) for b, c in zip(bins, names, strict=True)), "fold", "y").groupBy(*names, "fold", "y").agg(F.count("*").alias("n"))


def fit_table(rows: DataFrame, edges: list[np.ndarray], counts: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> tuple[list[dict], DataFrame]:
    """The models of fit_trees() on all rows of a table (as _binned() gives them): one without each fold,
    and one of all folds, with bins for thresholds; and rows with all models' scores s0, s1, ...  counts:
    rows by fold and y; both classes weigh the same.

    Each level of a tree is one pass, for all models at once: gradients are summed by model, node, feature and
    bin, and only those sums reach the driver, whatever the number of rows."""
    total = counts.sum()
    weight = [0.5 * total / max(n, 1) for n in counts.sum(0)]
    models = []
    for m in range(FOLDS + 1):
        own = counts[[k for k in range(FOLDS) if k != m]].sum(0)
        models.append({"base": _base(own[1] * weight[1], own[0] * weight[0]), "trees": []})
    bins = tuple(f"b{j}" for j in range(len(edges)))
    w = f"IF(y > 0, {float(weight[1])!r}D, {float(weight[0])!r}D)"
    leaf = lambda g, h: float(-RATE * g / (h + 1))
    scores = [F.lit(model["base"]) for model in models]

    def sums(level: int, splits: list[dict[int, tuple[int, int]]]) -> np.ndarray:
        at = lambda own, k: f"CASE WHEN {bins[own[k][0]]} <= {own[k][1]} THEN {at(own, 2 * k)} ELSE {at(own, 2 * k + 1)} END" if k in own else str(k if k >= 1 << level else 0)
        nodes = [F.expr(f"IF(fold = {m}, 0, {at(own, 1)})").alias(f"k{m}") for m, own in enumerate(splits)]
        chances = [(1 / (1 + F.exp(-c))).alias(f"p{m}") for m, c in enumerate(scores)]
        seen = rows.select("n", "y", F.expr(w).alias("w"), *bins, *nodes, *chances)
        parts = ", ".join(f"struct({m} AS m, k{m} AS k, CAST(round(w * (p{m} - y) * {UNIT}) AS long) * n AS g, CAST(round(w * p{m} * (1 - p{m}) * {UNIT}) AS long) * n AS h)" for m in range(len(models)))
        each = seen.select(F.expr(f"inline(array({parts}))"), *bins).where("k > 0").select("m", "k", "g", "h", F.posexplode(F.array(*bins)).alias("j", "b"))
        got = each.groupBy("m", "k", "j", "b").agg(F.sum("g"), F.sum("h")).collect()
        out = np.zeros((len(models), 1 << level, 2, len(bins), BINS))
        for m, k, j, b, g, h in got:
            out[m, k - (1 << level), :, j, b] = g, h
        return out / UNIT

    for done in range(trees if total else 0):
        splits: list[dict[int, tuple[int, int]]] = [{} for _ in models]
        values: list[dict[int, float]] = [{} for _ in models]
        for level in range(depth):
            if level and not any(k >= 1 << (level - 1) for own in splits for k in own):
                break  # no node was split
            got = sums(level, splits)
            for m, own in enumerate(splits):
                for k in range(1 << level, 2 << level):
                    if level and k // 2 not in own:
                        continue
                    g, h = got[m, k - (1 << level)]
                    values[m][k] = leaf(g[0].sum(), h[0].sum())
                    split = best_split(g, h, [len(e) + 1 for e in edges])
                    if split is not None:
                        j, b = own[k] = split
                        for side, to in ((2 * k, slice(None, b + 1)), (2 * k + 1, slice(b + 1, None))):
                            values[m][side] = leaf(g[j, to].sum(), h[j, to].sum())
        for m, model in enumerate(models):
            tree = lambda k: (*splits[m][k], tree(2 * k), tree(2 * k + 1)) if k in splits[m] else values[m][k]  # noqa: B023, E731
            model["trees"].append(tree(1))
            scores[m] = scores[m] + tree_score({"base": 0.0, "trees": model["trees"][-1:]}, bins)
        if done % WRITE == WRITE - 1:
            rows = stage(rows.select(*bins, "fold", "y", "n", *(c.alias(f"s{m}") for m, c in enumerate(scores))), "scores")
            scores = [F.col(f"s{m}") for m in range(len(models))]
    return models, rows.select(*bins, "fold", "y", "n", *(c.alias(f"s{m}") for m, c in enumerate(scores)))


def _limit(rows: DataFrame, most_wrong: float) -> float:
    """The probability from which on at most most_wrong of the allowed rows are, judged by the models
    that were fitted without their fold; 0.5 at least."""
    own = F.element_at(F.array(*(f"s{m}" for m in range(FOLDS))), F.col("fold") + 1)
    p = F.ceil(65536 / (1 + F.exp(-own))).alias("p")
    counts = sorted(rows.where("y = 0").groupBy(p).agg(F.sum("n").alias("n")).collect())
    if not counts:
        return 0.5
    p, n = (np.array(c) for c in zip(*counts, strict=True))
    at = math.ceil((int(n.sum()) - 1) * (1 - most_wrong))
    return max(0.5, float(np.nextafter(p[np.searchsorted(np.cumsum(n), at, "right")] / 65536, 1)))


def block_chance(model: dict, x: np.ndarray) -> np.ndarray:
    """The fitted trees' probabilities for rows of features."""

    def walk(node, rows: np.ndarray) -> None:
        if isinstance(node, tuple):
            low = x[rows, node[0]] <= node[1]
            walk(node[2], rows[low])
            walk(node[3], rows[~low])
        else:
            score[rows] += node

    score = np.full(len(x), model["base"])
    for tree in model["trees"]:
        walk(tree, np.arange(len(x)))
    return 1 / (1 + np.exp(-score))


def tree_score(model: dict, features: tuple[str, ...] = FEATURES) -> Column:
    """The fitted trees as one expression: nested CASE WHENs that stay in generated code."""
    say = lambda n: f"{n!r}D" if isinstance(n, float) else f"CASE WHEN {features[n[0]]} <= {n[1]!r}D THEN {say(n[2])} ELSE {say(n[3])} END"
    return F.expr(" + ".join([f"{model['base']!r}D", *(f"({say(t)})" for t in model["trees"])]))


def suffix_rates(rows: list[tuple[str, float, float]]) -> dict[str, float]:
    """The weighted share of blocked URLs by suffix, shrunk towards 0, from rows (suffix, blocked weight, weight)."""
    sums: dict[str, list[float]] = {}
    for tail, blocked, weight in rows:
        own = sums.setdefault(tail, [0.0, 0.0])
        own[0] += blocked
        own[1] += weight
    return {tail: b / (n + 10) for tail, (b, n) in sums.items()}


def url_verdicts(pages: DataFrame, url_col: str = "url", rules=RULES, most_wrong: float = MOST_WRONG) -> DataFrame:
    """All rows of pages with host, path, rule, verdict ('allow' or 'block') and block_probability.

    Rules decide the URLs they fit.  The URLs that rules decide, all of them, are the labels that the trees
    learn from; the trees decide all others.  The suffix feature is the share of blocked URLs of the last
    host label in those rows, out of fold for the rows themselves and shrunk towards 0: a suffix without
    evidence counts as clean.  Suffixes that a rule names give no evidence, as there the rule is the label.
    The trees block from the probability on that at most most_wrong of the allowed labelled URLs reach out
    of fold.

    What the trees say carries little evidence where the rules are the only labels: they learn the rules'
    choice of hosts and paths from other features of the URLs.  With labels of another kind, give
    fit_trees() those.

    Null or odd URLs have empty host and path and are judged by the trees; without any labelled URL
    everything that no rule fits is allowed; columns of pages named host, path, rule or verdict are
    replaced.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "block_probability")]
    names = [f"_c{i}" for i in range(len(keep))]  # the features' names may be taken
    pages, url_col = pages.select(*keep).toDF(*names), names[keep.index(url_col)]
    rows = lexical(pages, url_col)
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_said": said})
    labelled = rows.where("_said is not null").select(*FEATURES[:-1], "f_tail", (F.col("_said") == "block").cast("int").alias("y"), F.pmod(F.xxhash64(url_col), F.lit(FOLDS)).cast("int").alias("fold"))
    labelled = stage(labelled, "labelled")
    found = labelled.groupBy("f_tail", "fold", "y").agg(F.count("*").alias("n")).collect()  # a labelled URL has a rule's suffix
    counts = np.zeros((FOLDS, 2))
    for r in found:
        counts[r["fold"], r["y"]] += r["n"]
    each = [0.5 * counts.sum() / max(n, 1) for n in counts.sum(0)]  # both classes weigh the same
    fixed = {h for h, _, _ in (r.partition("/") for r, _ in rules) if "." not in h}  # a rule decides all or part of these suffixes
    tails = lambda own: suffix_rates([(r["f_tail"], r["y"] * r["n"] * each[r["y"]], r["n"] * each[r["y"]]) for r in own if r["f_tail"] not in fixed])
    rate = {t: [tails(r for r in found if r["fold"] != k).get(t, 0.0) for k in range(FOLDS)] for t in tails(found)}  # a row's own label is not in its feature
    known = lambda of: F.coalesce(F.create_map(*(F.lit(c) for t in of.items() for c in t))[F.col("f_tail")], F.lit(0.0)) if of else F.lit(0.0)
    out_of_fold = F.lit(0.0)
    for k in range(FOLDS if rate else 0):
        out_of_fold = F.when(F.col("fold") == k, known({t: v[k] for t, v in rate.items()})).otherwise(out_of_fold)
    labelled = labelled.withColumn("f_suffix", out_of_fold)
    edges = _edges(labelled)
    binned = stage(_binned(labelled, edges), "binned")
    models, judged_rows = fit_table(binned, edges, counts)
    threshold = _limit(judged_rows, most_wrong)
    back = lambda t: (t[0], float(edges[t[0]][t[1]]), back(t[2]), back(t[3])) if isinstance(t, tuple) else t
    model = {"base": models[-1]["base"], "trees": [back(t) for t in models[-1]["trees"]]}
    scored = rows.withColumn("f_suffix", known(tails(found)))
    scored = scored.withColumn("block_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-tree_score(model))))
    judged = F.coalesce(F.col("_said"), F.when(F.col("block_probability") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    back_names = [F.col(n).alias(c) for n, c in zip(names, keep, strict=True)]
    return scored.withColumn("verdict", judged).select(*back_names, "host", "path", "rule", "verdict", "block_probability")
