"""Reviews, labels and release gates: joins of records with decisions, four-state statistics, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("supported", "no_support", "uncertain", "not_evaluated")


def status(records: DataFrame, decisions: DataFrame, key: str, content: str) -> DataFrame:
    """records with verdict: that of the decision on the same content, `stale` if the content has changed, `pending` without a decision."""
    d = decisions.select(F.col(key), F.col(content).alias("_seen"), F.col("verdict").alias("_verdict"))
    joined = records.join(d, key, "left")
    verdict = F.when(F.col("_seen").isNull(), "pending").when(F.col("_seen") != F.col(content), "stale").otherwise(F.col("_verdict"))
    return joined.withColumn("verdict", verdict).drop("_seen", "_verdict")


def label_states(long: DataFrame, by: str = "tag") -> DataFrame:
    """For rows (record, tag, state): per tag the four counts, index (percent supported), evaluated share; null where nothing counts."""
    counts = [F.count_if(F.col("state") == s).alias(s) for s in STATES]
    out = long.groupBy(by).agg(F.count("*").alias("records"), *counts)
    return out.withColumn("index_pct", F.try_divide(100.0 * F.col("supported"), F.col("records"))).withColumn("coverage", F.try_divide(1.0 * (F.col("records") - F.col("not_evaluated")), F.col("records")))


def agreement(pairs: DataFrame, truth: Column, guess: Column, by: str) -> DataFrame:
    """Counts of a yes-or-no label against a prediction: tp, fp, fn, tn, precision and recall (null without a denominator)."""
    n = lambda t, g: F.count_if((truth == t) & (guess == g))
    out = pairs.groupBy(by).agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))
    share = lambda other: F.try_divide(1.0 * F.col("tp"), F.col("tp") + F.col(other))
    return out.withColumn("precision_", share("fp")).withColumn("recall_", share("fn"))


def scored(gold: DataFrame, predictions: DataFrame, tags: tuple[str, ...]) -> DataFrame:
    """Predicted labels (id, sha, category, tags) against reviewed ones (id, sha, category, tags, complete): a row of all samples, tag null, and one for each tag.

    samples, returned (predictions of known samples with the same sha; the rest is stale or unknown and counts for nothing), agreed (equal categories),
    among_returned and among_all (agreed by either), compared (returned samples whose tags were assessed in full), incomplete (samples whose tags were not).
    A tag's row has tp, fp, fn, tn among the compared ones, precision and recall, null where nothing is claimed or present."""
    p = predictions.select("id", "sha", F.col("category").alias("_category"), F.coalesce("tags", F.array().cast("array<string>")).alias("_tags"), F.lit(True).alias("_returned"))
    both = gold.join(p, ["id", "sha"], "left").withColumn("_returned", F.coalesce("_returned", F.lit(False)))
    n, returned = lambda c: F.count_if(F.coalesce(c, F.lit(False))), F.col("_returned")
    compared = returned & F.col("complete")
    has = lambda c, tag: F.array_contains(F.col(c), tag)
    counts = [F.struct(F.lit(tag).alias("tag"), n(compared & has("tags", tag) & has("_tags", tag)).alias("tp"), n(compared & ~has("tags", tag) & has("_tags", tag)).alias("fp"), n(compared & has("tags", tag) & ~has("_tags", tag)).alias("fn"), n(compared & ~has("tags", tag) & ~has("_tags", tag)).alias("tn")) for tag in tags]
    none = F.lit(None).cast("long")
    whole = F.struct(F.lit(None).cast("string").alias("tag"), *(none.alias(c) for c in ("tp", "fp", "fn", "tn")))
    base = both.agg(F.count("*").alias("samples"), n(returned).alias("returned"), n(returned & (F.col("category") == F.col("_category"))).alias("agreed"), n(compared).alias("compared"), n(~F.col("complete")).alias("incomplete"), F.array(whole, *counts).alias("t"))
    rows = base.select("samples", "returned", "agreed", F.try_divide(1.0 * F.col("agreed"), F.col("returned")).alias("among_returned"), F.try_divide(1.0 * F.col("agreed"), F.col("samples")).alias("among_all"), "compared", "incomplete", F.inline("t"))
    share = lambda other: F.try_divide(1.0 * F.col("tp"), F.col("tp") + F.col(other))
    return rows.withColumn("precision_", share("fp")).withColumn("recall_", share("fn"))


def public_counts(views: DataFrame, top: int = 8, least: int = 20, step: int = 10) -> DataFrame:
    """Views (country, pv) for publication: the largest `top` countries of at least `least`, the rest as OTHER if large enough, rounded down; total."""
    sums = views.groupBy("country").agg(F.sum("pv").alias("pv"))
    shown = sums.filter((F.col("country") != "ZZ") & (F.col("pv") >= least)).orderBy(F.desc("pv"), "country").limit(top)  # the report's length
    rest = sums.join(shown.select("country"), "country", "left_anti").agg(F.lit("OTHER").alias("country"), F.sum("pv").alias("pv")).filter(F.col("pv") >= least)
    total = sums.agg(F.lit("TOTAL").alias("country"), F.sum("pv").alias("pv")).filter(F.col("pv") >= least)
    return shown.unionByName(rest).unionByName(total).withColumn("pv", (F.floor(F.col("pv") / step) * step).cast("long"))


def release_problems(now: DataFrame, before: DataFrame) -> DataFrame:
    """Problems of a candidate's one-row figures against the previous release's, as rows: problem. No rows: it may be published.

    Figures: discovered, fetched, pending, failed, mapped, unlocated, month_total.
    """
    old = before.select(F.lit(1).alias("_k"), *(F.col(c).alias(f"old_{c}") for c in ("discovered", "fetched", "mapped")))
    both = now.withColumn("_k", F.lit(1)).join(old, "_k", "left")  # a row on each side
    rules = (
        ((F.col("pending") > 0) | (F.col("failed") > 0), "source backlog or errors"),
        (F.col("fetched") != F.col("mapped") + F.col("unlocated"), "mapped and unlocated do not sum to fetched"),
        (F.col("month_total") != F.col("fetched"), "months do not sum to fetched"),
        ((F.col("discovered") < F.col("old_discovered")) | (F.col("fetched") < F.col("old_fetched")), "fewer reports than before"),
        (F.col("mapped") < F.col("old_mapped"), "fewer located reports than before"),
    )
    return both.select(F.explode(F.array_compact(F.array(*(F.when(c, what) for c, what in rules)))).alias("problem"))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids that only one of two inventories has: key, side (left, right)."""
    only = lambda x, y, side: x.select(key).distinct().join(y, key, "left_anti").withColumn("side", F.lit(side))
    return only(a, b, "left").unionByName(only(b, a, "right"))


def digest(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """One digest of a table's rows in any order, in one row: n, part_0 to part_3 (sums of quarters of the rows' hashes), digest (of these).

    Sums combine before the shuffle, so no task gathers the table; rows that differ in number or content give other sums. The key has to be
    one of the columns if its order is to matter.
    """
    h = F.sha2(F.concat_ws("\u001f", *(F.col(c).cast("string") for c in (key, *cols))), 256)
    parts = [F.sum(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")).alias(f"part_{i}") for i in range(4)]
    out = df.agg(F.count("*").alias("n"), *parts)
    return out.withColumn("digest", F.sha2(F.concat_ws(":", "n", *(f"part_{i}" for i in range(4))), 256))
