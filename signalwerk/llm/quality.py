"""A ledger of quality rules: every rule is evaluated once, its failure is a bit, and policies are masks over those bits."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_or_empty

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")

#: Rules by bit: a name, and SQL over the measures that is true where a document fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
)
#: Versions of policies: the rules that a kept document must pass.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(name for name, _ in RULES),
}


def mask(policy: str) -> int:
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[name] for name in POLICIES[policy])


def repeated_words(words: list[str]) -> int:
    """How many words lie in five-word windows that the text has twice or more."""
    import numpy as np

    n = len(words)
    if n < 6:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    v = len(seen)
    pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1].reshape(-1)  # equal numbers, equal pairs
    p = int(pairs.max()) + 1
    fours = np.unique(pairs[:-2] * p + pairs[2:], return_inverse=True)[1].reshape(-1)
    _, which, count = np.unique(fours[:-1] * v + ids[4:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[which.reshape(-1)] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + 5, -1)
    return int(np.count_nonzero(np.cumsum(cover[:n]) > 0))


def measure(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dups = sum(c - 1 for c in Counter(lines).values())
    return len(words), sum(map(len, words)), len(SYMBOL.findall(text)), dups, len(lines), repeated_words(words)


def measured(rows: DataFrame, keep: str) -> DataFrame:
    """rows (a column `keep`, and text, or a struct with one in `keep`) with text replaced by the measures and by failed, the bits of the rules that a document fails."""
    inside = "text" not in rows.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            text = batch.column(keep).field("text").cast(pa.string()) if inside else batch.column("text")
            for part in slices(pa.RecordBatch.from_arrays([batch.column(keep), text], names=[keep, "text"]), rows=2048):
                found = list(zip(*(measure(x or "") for x in part.column("text").to_pylist()), strict=True))
                yield pa.RecordBatch.from_arrays([part.column(keep), *(pa.array(c, pa.int64()) for c in found)], names=[keep, *MEASURES])

    kept = rows.select(keep).schema.fields[0]
    schema = T.StructType([kept, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    found = rows.mapInArrow(run, schema)
    return found.withColumn("failed", sum((F.when(F.expr(sql), 1 << i).otherwise(0) for i, (_, sql) in enumerate(RULES)), F.lit(0)).cast("long"))


def passes(policy: str) -> Column:
    """Whether a document passes the base rules and a policy, by its failure bits alone."""
    return F.col("failed").bitwiseAND(F.lit(mask("base") | mask(policy)).cast("long")) == 0


def ledger(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, the measures, and failed, the bits of the rules that it fails.

    Null text has no words, as empty text; a text of any length is measured whole; rows, repeated ones too, are taken one by one; an empty
    table gives no rows. Other columns are ignored."""
    return measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), "doc_id")


def judged(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """A ledger with base_failed and, under a policy, kept."""
    base = F.col("failed").bitwiseAND(F.lit(mask("base")).cast("long")) != 0
    return entries.withColumn("base_failed", base).withColumn("kept", passes(policy))


def ablations(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that would be kept without it. Reads failure bits only."""
    m = mask(policy)
    sets = entries.groupBy(F.col("failed").bitwiseAND(F.lit(m).cast("long")).alias("failed")).agg(F.count("*").alias("n"))  # at most 2**len(RULES) rows
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (name, _) in enumerate(RULES) if m >> i & 1))
    both = sets.select("failed", "n", F.inline(rules))
    has = F.col("failed").bitwiseAND(F.col("bit")) != 0
    without = F.col("failed").bitwiseAND(F.bitwise_not("bit")) == 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return both.groupBy("rule").agg(total(has).alias("n_failed"), total(has & without).alias("n_failed_alone"), total(without).alias("n_kept_without"))


def filtered(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """Documents that a policy keeps, with their columns, by the ledger's bits; nothing is joined back. ledger() tells how odd rows are taken.

    A document's columns travel in a struct, so none can clash with the measures."""
    return measured(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")), "row").filter(passes(policy)).select("row.*")


MEASURES_SQL = r"""
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
grams AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) > 4)),
again AS (SELECT doc_id, i FROM grams JOIN (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1) USING (doc_id, gram)),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY 1),
measured AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN cover USING (doc_id)),
bits AS (
  SELECT *, ((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (word_chars < 2 * n_words)::INT
    + 16 * (word_chars > 20 * n_words)::INT + 32 * (10 * n_dup_lines > 3 * n_lines)::INT)::BIGINT AS failed FROM measured)
"""
ORACLE = f"WITH {MEASURES_SQL} SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM bits"
ABLATIONS_ORACLE = f"""WITH {MEASURES_SQL}, rules AS (SELECT unnest(['few_words', 'repeated_words', 'symbols', 'short_words', 'long_words', 'repeated_lines']) AS rule, unnest([1, 2, 4, 8, 16, 32]) AS bit)
SELECT rule, count_if(failed & bit <> 0)::BIGINT AS n_failed, count_if(failed = bit)::BIGINT AS n_failed_alone, count_if(failed & ~bit = 0)::BIGINT AS n_kept_without FROM bits, rules GROUP BY rule"""
