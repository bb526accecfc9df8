"""Exact positions inside groups of any size.

``row_number`` over a partition puts a whole group into one task. The helpers
here cut large inputs into value ranges first, number each range on its own
and add the row count of the ranges before it, so a group that holds a third of
all rows is still spread over the cluster. Results are exact: only the choice
of range borders is sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Below this many rows in total no group can be too large for one task.
SAFE_ROWS = 500_000
# The same for rows that carry a text or a payload of some thousand characters.
SAFE_TEXTS = 20_000
# Ranges are borders on the driver and literals in the plan, so their number is bounded;
# a range of more rows is numbered by an external sort.
MAX_RANGES = 256
# Pieces of a text, or entries of a list, that share one row.
PART_PIECES = 1000


def _borders(df: DataFrame, cols: Sequence[str], n: int, ranges: int) -> list:
    """Range borders from a hash sample of about 32 rows per range."""
    step = max(1, n // (ranges * 32))
    rows = (
        df.select(*cols)
        .where(F.pmod(F.xxhash64(*cols), F.lit(step)) == 0)
        .collect()
    )
    rows = sorted({tuple(r) for r in rows}, key=lambda t: [(v is not None, v) for v in t])
    return [rows[i * len(rows) // ranges] for i in range(1, ranges)] if len(rows) > ranges else rows


def _range_no(df: DataFrame, cols: Sequence[str], borders: list) -> Column:
    """Index of the range a row falls in, as a balanced tree of comparisons."""
    key = F.struct(*[F.col(c).alias(c) for c in cols])

    def literal(values) -> Column:
        return F.struct(
            *[F.lit(v).cast(df.schema[c].dataType).alias(c) for v, c in zip(values, cols)]
        )

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < literal(borders[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(borders))


def dense_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "idx",
    total: str | None = None,
    safe_rows: int = SAFE_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in its group, and the group size
    as ``total`` on request. ``order`` must be unique within a group."""
    keys, order = list(keys), list(order)
    n = df.count()
    if n <= safe_rows:
        out = df.withColumn(
            name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - F.lit(1)
        )
        if total:
            out = out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        return out

    cols = keys + order
    ranges = int(min(MAX_RANGES, max(2, 2 * n // safe_rows)))
    borders = _borders(df, cols, n, ranges)
    cut = df.withColumn("_range", _range_no(df, cols, borders))
    per_range = cut.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    local = cut.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1
    )
    match = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = local.join(offsets, match)
    picked = [F.col(c) for c in df.columns] + [(F.col("_local") + F.col("_before")).alias(name)]
    if total:
        picked.append(F.col("_total").alias(total))
    return out.select(*picked)


def even_spread(
    df: DataFrame, k: int | Column, keys: Sequence[str], order: Sequence[str], safe_rows: int = SAFE_ROWS
) -> DataFrame:
    """``k`` rows per group at positions floor(i * n/k); all rows when k >= n,
    none when k <= 0. Whether a row is picked depends on its own position."""
    k = F.lit(k) if isinstance(k, int) else k
    placed = dense_index(df.withColumn("_k", k), keys, order, "_idx", "_n", safe_rows)
    step = F.col("_n") / F.col("_k").cast("double")
    guess = F.floor(F.col("_idx") / step).cast("bigint")

    def lands(i: Column) -> Column:
        return (i >= 0) & (i < F.col("_k")) & (F.floor(i.cast("double") * step) == F.col("_idx"))

    hit = lands(guess - 1) | lands(guess) | lands(guess + 1)
    keep = F.when(F.col("_k") <= 0, False).when(F.col("_k") >= F.col("_n"), True).otherwise(hit)
    return placed.where(keep).drop("_k", "_n", "_idx")


def chunk_rows(
    df: DataFrame, size: int, keys: Sequence[str], order: Sequence[str], safe_rows: int = SAFE_ROWS
) -> DataFrame:
    """Consecutive groups of ``size`` rows: group number ``grp`` and place ``slot``."""
    out = dense_index(df, keys, order, "_idx", None, safe_rows)
    return (
        out.withColumn("grp", F.floor(F.col("_idx") / size).cast("bigint"))
        .withColumn("slot", (F.col("_idx") % size).cast("int"))
        .drop("_idx")
    )


def assemble_text(
    pieces: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    sep: str = "",
    per_part: int = PART_PIECES,
    safe_rows: int = SAFE_ROWS,
) -> DataFrame:
    """Join the text pieces of each group in order into numbered parts.

    A part holds ``per_part`` consecutive pieces as one ``text`` string. Every
    group has ``parts`` rows, ``part`` counting from 0; laid end to end with
    ``sep`` between them they are the whole text, whatever its size."""
    keys, order = list(keys), list(order)
    placed = dense_index(pieces.select(*keys, *order, text), keys, order, "_idx", "_n", safe_rows)
    part = F.floor(F.col("_idx") / per_part).cast("int")
    parts = F.ceil(F.col("_n") / per_part).cast("int")
    return (
        placed.withColumn("part", part)
        .withColumn("parts", parts)
        .groupBy(*keys, "part", "parts")
        .agg(F.sort_array(F.collect_list(F.struct("_idx", F.col(text).alias("_t")))).alias("_p"))
        .select(*keys, "part", "parts", F.array_join(F.col("_p._t"), sep).alias(text))
    )


def list_parts(
    rows: DataFrame, key: str, value: str, per_part: int = PART_PIECES, safe_rows: int = SAFE_ROWS
) -> DataFrame:
    """The sorted list of ``value`` per ``key`` in numbered parts:
    key, part, parts, list."""
    placed = dense_index(rows.select(key, value), [key], [value], "_idx", "_n", safe_rows)
    return (
        placed.withColumn("part", F.floor(F.col("_idx") / per_part).cast("int"))
        .withColumn("parts", F.ceil(F.col("_n") / per_part).cast("int"))
        .groupBy(key, "part", "parts")
        .agg(F.array_sort(F.collect_list(value)).alias("list"))
    )
