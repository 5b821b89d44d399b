"""Labels: filling, rule cascade, false-positive correction, batches, comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..functions import text as T
from ..rules import RuleSet
from . import places


def fill(said: Column, rules: RuleSet) -> Column:
    """A model's label if it is a valid one, else the neutral one."""
    return F.when(said.isin(*rules.labels), said).otherwise(rules.neutral)


def matches(c: Column, patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out |= F.coalesce(T.lower(c).rlike(T.rx(p)), F.lit(False))
    return out


def cascade(label: Column, c: Column, rules: RuleSet) -> Column:
    """The first list's rules force the first class, else the second list's the second."""
    return F.when(matches(c, rules.first_patterns), rules.first).when(matches(c, rules.second_patterns), rules.second).otherwise(label)


def correct(label: Column, c: Column, rules: RuleSet) -> Column:
    """First-class rows that hold the doubtful token and no strong word become neutral."""
    if not rules.doubtful:
        return label
    doubtful = F.contains(T.lower(c), F.lit(rules.doubtful)) & ~T.special(T.text(c), rules.strong)
    return F.when((label == rules.first) & doubtful, rules.neutral).otherwise(label)


def label_comments(df: DataFrame, rules: RuleSet, model: DataFrame | None = None, key: str = "comment_id", column: str = "comment_raw") -> DataFrame:
    """df with label: the model's (key, label) where there is one, then rules, then the correction.  Rows
    whose summary is null stay unlabelled ('') where df has summaries."""
    said = df.drop("label") if model is None else df.drop("label").join(model.select(key, F.col("label").alias("_said")), key, "left")
    start = fill(F.col("_said"), rules) if model is not None else F.lit(rules.neutral)
    out = said.withColumn("label", start).drop("_said").withColumn("label", cascade(F.col("label"), F.col(column), rules))
    out = out.withColumn("label", correct(F.col("label"), F.col(column), rules))
    return out.withColumn("label", F.when(F.col("summary").isNull(), "").otherwise(F.col("label"))) if "summary" in df.columns else out


def label_batches(df: DataFrame, order: list[Column], size: int = 50, key: str = "comment_id", column: str = "comment_raw") -> DataFrame:
    """One row per call: summary, batch, ids and the JSON of its comments (cut to 300 characters, the
    summary to 200).  Rows without a summary or an id are in no call; of rows of a batch that share an id
    the last by text is shown, and its answer counts for all of them."""
    rows = places.chunks(df.where(F.col("summary").isNotNull() & F.col(key).isNotNull()), order, size, "summary")
    items = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("id"), T.ellipsis(F.col(column), 300).alias("body"))))
    out = rows.groupBy("summary", "batch").agg(items.alias("items"))
    ids = F.array_distinct(F.col("items.id"))
    return out.select(T.ellipsis(F.col("summary"), 200).alias("summary"), "batch", ids.alias("ids"), jsontext.comments_json(F.col("items.id"), F.col("items.body")).alias("comments"))


def exploded_labels(responses: DataFrame, column: str = "response") -> DataFrame:
    """id, label of every pair in label-map responses; bad text gives none."""
    return responses.select(F.explode(jsontext.label_map(F.col(column))).alias("id", "label"))


def compare(a: DataFrame, b: DataFrame, ordinal: str, column: str = "comment_raw") -> DataFrame | None:
    """Rows of two label sets by position with same (two missing labels differ); None if their lengths
    differ."""
    if a.count() != b.count():
        return None
    rows = a.select(ordinal, column, F.col("label").alias("model1_label")).join(b.select(ordinal, F.col("label").alias("model2_label")), ordinal)
    return rows.withColumn("same", F.coalesce(F.col("model1_label") == F.col("model2_label"), F.lit(False))).withColumn("comment_text", T.ellipsis(F.col(column), 100))


def compare_by_position(a: DataFrame, b: DataFrame, order_a: list[Column], order_b: list[Column], column: str = "comment_raw") -> DataFrame | None:
    """compare() of two label sets in orders of their own: the first rows of both, the second ones, and so
    on, with the row's place as index."""
    return compare(places.ordinals(a, order_a, "index"), places.ordinals(b, order_b, "index"), "index", column)


def differences(compared: DataFrame, n: int = 20, order: str = "index") -> DataFrame:
    """The first n rows whose labels differ."""
    return compared.where("not same").orderBy(order).limit(n)


def comparison_report(compared: DataFrame, names: tuple[str, str] = ("model1", "model2"), shown: int = 10) -> DataFrame:
    """The lines of a comparison as one column, for a text file: totals, each label's counts, and the first
    differences.  It has shown + 5 lines and one for each label."""
    a = agreement(compared).select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("at"), F.concat_ws(
        "\n", F.concat(F.lit("Records: "), F.col("total").cast("string")), F.concat(F.lit("Same labels: "), F.col("matches").cast("string")),
        F.concat(F.lit("Different labels: "), F.col("differences").cast("string")), F.concat(F.lit("Agreement: "), F.format_number(F.coalesce("accuracy", F.lit(0.0)), 1), F.lit(" %")),
    ).alias("value"))
    counts = distributions(compared)
    b = counts.select(F.lit(1).alias("part"), F.lit(0).cast("long").alias("at"), F.concat(F.coalesce("label", F.lit("-")), F.lit(f": {names[0]} "), F.col("model1").cast("string"), F.lit(f", {names[1]} "), F.col("model2").cast("string")).alias("value"))
    c = differences(compared, shown).select(F.lit(2).alias("part"), F.col("index").alias("at"), F.concat(F.col("index").cast("string"), F.lit(". "), F.col("comment_text"), F.lit(" | "), F.coalesce("model1_label", F.lit("-")), F.lit(" | "), F.coalesce("model2_label", F.lit("-"))).alias("value"))
    return a.unionByName(b).unionByName(c).orderBy("part", "at", "value").select("value")


def agreement(compared: DataFrame) -> DataFrame:
    n, same = F.count("*"), F.count_if("same")
    return compared.agg(n.alias("total"), same.alias("matches"), (n - same).alias("differences"), F.try_divide(same * 100.0, n).alias("accuracy"))


def distributions(compared: DataFrame) -> DataFrame:
    """Counts of each label by either model, side by side."""
    long = compared.select(F.explode(F.array(F.struct(F.lit(1).alias("m"), F.col("model1_label").alias("label")), F.struct(F.lit(2).alias("m"), F.col("model2_label").alias("label")))).alias("x"))
    return long.select("x.*").where("label is not null").groupBy("label").agg(F.count_if(F.col("m") == 1).alias("model1"), F.count_if(F.col("m") == 2).alias("model2"))


def demo(df: DataFrame, label: Callable[[DataFrame], DataFrame], n: int, key: str) -> DataFrame:
    """Labels a seeded sample of 1 to 100 rows."""
    from .groups import sample

    return label(sample(df, max(1, min(100, n)), key)).select(F.col(key).alias("comment_idx"), F.col("comment_raw").alias("comment"), "label")
