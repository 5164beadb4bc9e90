"""What the operators share: vocabulary files, small Column helpers, batch slicing and joins of hot keys."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUBLIC_TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; resolved where it is opened, so executors use their own installation."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"{PUBLIC_TOKENIZERS}/{name}"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batch, rows: int = 256, size: int = 2_000_000, by: str = "text") -> Iterator:
    """Parts of an Arrow batch of at most `rows` rows and, unless a single row is longer, about `size` bytes of column `by`."""
    import pyarrow.compute as pc

    n = pc.fill_null(pc.binary_length(batch.column(by)), 0).to_pylist() if batch.num_rows else []
    start, held = 0, 0
    for i, x in enumerate(n):
        if i > start and (held + x > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += x
    if start < len(n):
        yield batch.slice(start)


def dealt_join(rows: DataFrame, one: DataFrame, key: str, by: str, total: int, share: int = 10_000, salts: int = 64) -> DataFrame:
    """rows joined with `one`, which has one row per key and in `n_rows` how many of the `total` rows have that key. n_rows is dropped.

    A key of more than a `share`-th of all rows is hot. There are fewer than `share` hot keys, so they are broadcast; their rows are dealt
    by a hash of column `by` over `salts` parts, and their row of `one` goes to each part.
    """
    hot = F.col("n_rows") > max(total // share, 1000)
    marked = rows.join(F.broadcast(one.filter(hot).select(key, F.lit(True).alias("_hot"))), key, "left")
    marked = marked.withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return marked.join(one.withColumn("_salt", F.explode(parts)).drop("n_rows"), [key, "_salt"]).drop("_salt")
