"""Global orders without a sort of everything in one task: places and running sums by blocks of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.session import cut

#: Rows a block is made for. Rows of one value stay in one block, so orders are for groups' totals, not for raw rows.
BLOCK = 50_000


def placed(rows: DataFrame, by: str, key: str, *, place: str = "_place", running: str = "_running", block: int = BLOCK) -> tuple[DataFrame, int]:
    """(`rows` with the place of each, from 1, in order of a numeric column and then the key, and the sum of the column up to and
    with it; the number of rows). Blocks have fixed edges, so a repeated task sees the same rows; nulls of `by` are left out."""
    given = cut(rows.where(F.col(by).isNotNull()), "ordered")
    n = given.count()
    parts = max(1, -(-n // block))
    edges = sorted(set(given.approxQuantile(by, [j / parts for j in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    number = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: F.col(by) >= e)) if edges else F.lit(0)
    blocked = given.withColumn("_b", number)
    sizes = blocked.groupBy("_b").agg(F.count("*").alias("_n"), F.sum(by).alias("_s"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"))
    inner = Window.partitionBy("_b").orderBy(by, key)
    out = blocked.join(F.broadcast(starts), "_b")  # n / BLOCK rows
    sums = F.sum(by).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumns({place: F.row_number().over(inner) + F.col("_n0"), running: sums + F.col("_s0")}).drop("_b", "_n0", "_s0"), n
