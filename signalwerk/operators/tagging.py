"""Reviews of social-context tags: statistics, faults, sums over cities, and merging of reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reviews import STATES

# Tags, the facets of one of them, and what a support may rest on.
TAGS = ("community_safety", "hate_discrimination", "political_motivation", "extremism_terrorism", "domestic_partner_violence", "gender_based_violence", "organized_crime", "trafficking_exploitation")
FACETS = ("anti_lgbt", "racism", "xenophobia", "religious_bias")
PARENT = "hate_discrimination"
BASES = ("police_category_stated", "narrative_lead")


def decision_faults(decisions: DataFrame) -> DataFrame:
    """Reviewed decisions (city, id, tag, verdict, basis, quotes, checked) with what is wrong with them: problems, an array.

    A support needs quotes of 15 to 240 characters and a basis, any verdict a checked text, a facet's support that of its parent."""
    parent = decisions.filter(F.col("tag") == PARENT).select("city", "id", F.col("verdict").alias("_parent"))
    rows = decisions.join(parent, ["city", "id"], "left")
    supported = F.col("verdict") == "supported"
    size = lambda q: F.length(F.trim(q)).between(15, 240)
    rules = (
        (~F.col("tag").isin(*TAGS, *FACETS) | ~F.col("verdict").isin(*STATES), "unknown decision"),
        ((F.col("verdict") != "not_evaluated") & ~F.col("checked"), "text is not checked"),
        (supported & ((F.coalesce(F.size("quotes"), F.lit(0)) == 0) | ~F.forall("quotes", size) | ~F.coalesce(F.col("basis").isin(*BASES), F.lit(False))), "support without evidence"),
        (F.col("tag").isin(*FACETS) & supported & ~F.coalesce(F.col("_parent") == "supported", F.lit(False)), "facet without parent"),
    )
    return rows.select(*decisions.columns, F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), what) for c, what in rules))).alias("problems"))


def statistics(records: DataFrame, decisions: DataFrame, by: str = "city") -> DataFrame:
    """Per city and tag, and for `all` cities: records, the four states, supports by basis, index (percent supported), evaluated share.

    Records (city, id) without a decision on a tag are not evaluated. Counts by city, tag, verdict and basis combine before anything is joined."""
    n = records.groupBy(by).agg(F.count("*").alias("records"))
    known = decisions.join(records.select(by, "id"), [by, "id"], "left_semi")
    each = known.groupBy(by, "tag").agg(*(F.count_if(F.col("verdict") == s).alias(s) for s in STATES[:3]), *(F.count_if((F.col("verdict") == "supported") & (F.col("basis") == b)).alias(b) for b in BASES))
    tags = F.explode(F.array(*map(F.lit, TAGS + FACETS))).alias("tag")
    rows = n.select(by, "records", tags).join(each, [by, "tag"], "left").na.fill(0)
    cols = ["records", *STATES[:3], *BASES]
    whole = rows.groupBy("tag").agg(*(F.sum(c).alias(c) for c in cols)).withColumn(by, F.lit("all"))
    rows = rows.unionByName(whole).withColumn("not_evaluated", F.col("records") - sum((F.col(s) for s in STATES[:3]), F.lit(0)))
    return rows.withColumn("index_pct", F.try_divide(100.0 * F.col("supported"), F.col("records"))).withColumn("evaluated", F.try_divide(1.0 * (F.col("records") - F.col("not_evaluated")), F.col("records")))


def catalogue_faults(summary: DataFrame, by: str = "city", whole: str = "all") -> DataFrame:
    """Where a catalogue of statistics() does not add up: tag, figure, total, of_cities. No rows: it does."""
    figures = ("records", *STATES, *BASES)
    long = summary.select(by, "tag", F.explode(F.create_map(*[x for c in figures for x in (F.lit(c), F.col(c).cast("long"))])).alias("figure", "n"))
    both = long.groupBy("tag", "figure").agg(F.sum(F.when(F.col(by) == whole, F.col("n"))).alias("total"), F.sum(F.when(F.col(by) != whole, F.col("n"))).alias("of_cities"))
    return both.filter(~F.col("total").eqNullSafe(F.col("of_cities")))


def merged(previous: DataFrame, supplement: DataFrame, keys: tuple[str, ...] = ("city", "id", "tag")) -> DataFrame:
    """Reviews (keys, sha, verdict) with a supplement's verdicts where there were none: keys, sha, verdict, problem.

    A supplement of another text, or one that would change an evaluated verdict, changes nothing and is told in `problem`."""
    p, s = previous.select(*keys, "sha", F.col("verdict").alias("_p")), supplement.select(*keys, F.col("sha").alias("_sha"), F.col("verdict").alias("_s"))
    evaluated = lambda c: F.coalesce(F.col(c), F.lit("not_evaluated")) != "not_evaluated"
    rows = p.join(s, list(keys), "full_outer")
    problem = F.when(F.col("sha").isNotNull() & evaluated("_s") & (F.col("sha") != F.col("_sha")), "other text").when(evaluated("_p") & evaluated("_s"), "already evaluated")
    verdict = F.when(problem.isNull() & evaluated("_s"), F.col("_s")).otherwise(F.coalesce("_p", F.lit("not_evaluated")))
    return rows.select(*keys, F.coalesce("sha", "_sha").alias("sha"), verdict.alias("verdict"), problem.alias("problem"))


def all_tags(decisions: Column, tags: tuple[str, ...]) -> Column:
    """A map of verdicts by tag filled up to all tags; those that it lacks are not evaluated."""
    return reduce(F.map_concat, [F.map_filter(decisions, lambda k, _: k.isin(*tags)), F.map_from_arrays(F.array_except(F.array(*map(F.lit, tags)), F.map_keys(decisions)), F.transform(F.array_except(F.array(*map(F.lit, tags)), F.map_keys(decisions)), lambda _: F.lit("not_evaluated")))])
