"""Removal of lines that many sites share.

A line is known by a 128-bit hash. HyperLogLog sketches of its sites, merged by aggregation, say which lines spread far; lines whose
estimate lies near the threshold get an exact count. Only hashes and positions are shuffled for the decision. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .common import dealt_join

LOG_BUCKETS = 12
SPACE = r"[ \t\r]+"


def normal(line: Column) -> Column:
    """A line without white space at its ends, inner runs of it being one space."""
    return F.trim(F.regexp_replace(line, SPACE, " "))


def line_table(docs: DataFrame) -> DataFrame:
    """A row per line with a word: doc_id, text_key, site, line_no (from 0), h1, h2. Null text has none; a null site counts as one site."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.withColumn("line", normal(F.col("line"))).filter("line <> ''")
    return rows.select("doc_id", "text_key", "site", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def spread_lines(by_site: DataFrame, min_sites: int) -> DataFrame:
    """Lines of at least min_sites sites, from a row per line and site with its first place and number of rows: h1, h2, first, n_rows."""
    margin = 4 * 1.04 / 2 ** (LOG_BUCKETS / 2)  # four standard errors of the sketch
    low, high = min_sites * (1 - margin) - 1, min_sites * (1 + margin) + 1
    sketched = by_site.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LOG_BUCKETS)).alias("sketch"), F.min("first").alias("first"), F.sum("n_rows").alias("n_rows"))
    sketched = sketched.select("h1", "h2", "first", "n_rows", F.hll_sketch_estimate("sketch").alias("about")).filter(F.col("about") >= low)
    near = sketched.filter(F.col("about") <= high)
    exact = by_site.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count("*").alias("n_sites")).filter(F.col("n_sites") >= min_sites)
    return sketched.filter(F.col("about") > high).drop("about").unionByName(near.join(exact, ["h1", "h2"], "left_semi").drop("about"))


def removals(docs: DataFrame, min_sites: int) -> DataFrame:
    """Line numbers to remove, ascending, of each document that loses any: doc_id, text_key, gone."""
    lines = line_table(docs)
    # partial aggregation leaves a row per line, site and task before the shuffle; a line of a third of all rows stays small
    by_site = lines.groupBy("h1", "h2", "site").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "line_no")).alias("first"), F.count("*").alias("n_rows"))
    by_site = stored(by_site, "line-sites")
    line = F.struct("h1", "h2").alias("line")
    spread = stored(spread_lines(by_site, min_sites).select(line, "first", "n_rows"), "spread-lines")
    # copies of a text have different ids, so these deal out a line of a third of all rows
    found = dealt_join(lines.select(line, "doc_id", "text_key", "line_no"), spread, "line", "doc_id", by_site.agg(F.sum("n_rows")).first()[0] or 0)
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")) & (F.col("line_no") == F.col("first.line_no"))
    return found.filter(~first).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def without(lines: Column, gone: Column) -> Column:
    """The lines whose numbers are not in the ascending array `gone`, as slices between them: linear in both."""
    starts = F.concat(F.array(F.lit(-1)), gone)
    ends = F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 2, e - s - 1)))


def deduplicated(docs: DataFrame, min_sites: int = 10) -> DataFrame:
    """docs with `text` cleaned, plus n_lines (with a word) and n_removed.

    A line that at least min_sites different sources have stays at its first place (smallest doc_id, then text hash, then line) and goes
    everywhere else. Lines are compared after normal(); blank lines stay. Null text stays null with 0 lines. Rows with equal doc_id and text
    are treated alike, so both keep a line whose first place they are. Null doc_ids come last. Other columns pass through; own n_lines and n_removed are replaced.
    """
    gone = removals(docs, min_sites).select(F.struct("doc_id", "text_key", "gone").alias("loses"))
    # in structs, no column of the documents can clash with those of the removals; what is computed has a struct of its own
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    both = rows.join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("loses.doc_id")) & (F.xxhash64("row.text") == F.col("loses.text_key")), "left")
    text, gone_here = F.col("row.text"), F.col("loses.gone")
    lines = F.split(text, "\n")
    kept = F.when(gone_here.isNull(), text).otherwise(F.array_join(without(lines, gone_here), "\n"))
    n = F.when(text.isNull(), 0).otherwise(F.coalesce(F.size(F.filter(lines, lambda x: normal(x) != "")), F.lit(0)))
    both = both.select("row", F.struct(kept.alias("text"), n.alias("n_lines"), F.coalesce(F.size(gone_here), F.lit(0)).alias("n_removed")).alias("new"))
    # no expression but column names from here on: an alias that is a struct's name would be taken for the struct
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return both.selectExpr(*[f"row.`{c}` AS `_{i}`" for i, c in enumerate(others)], "new.text AS _text", "new.n_lines AS _n_lines", "new.n_removed AS _n_removed").toDF(*others, "text", "n_lines", "n_removed")


ORACLE = """
WITH docs AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, source, i - 1 AS line_no, trim(regexp_replace(parts[i], '[ \\t\\r]+', ' ', 'g')) AS line
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM docs)),
worded AS (SELECT * FROM lines WHERE line <> ''),
spread AS (
  SELECT line, min((doc_id, line_no)) AS first FROM worded GROUP BY line HAVING count(DISTINCT coalesce(source, '')) >= 10),
gone AS (SELECT doc_id, line_no FROM worded JOIN spread USING (line) WHERE (doc_id, line_no) <> first),
per AS (SELECT doc_id, list(line_no) AS gone, count(*) AS n FROM gone GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
SELECT doc_id, coalesce(counted.n, 0) AS n_lines, coalesce(per.n, 0) AS n_removed,
  CASE WHEN per.n IS NULL THEN text
    ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(parts) + 1), lambda i: NOT list_contains(per.gone, i - 1)), lambda i: parts[i]), chr(10)), '') END AS text
FROM docs LEFT JOIN per USING (doc_id) LEFT JOIN counted USING (doc_id)
"""
