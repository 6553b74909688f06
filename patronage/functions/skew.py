"""Joining rows to a table of one row per key when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1000
SPREAD = 4096


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, spread_by: str,
           total: int | Column | None = None) -> DataFrame:
    """Left join of ``rows`` to ``table``, which has one row per key and says how many rows carry it.

    Keys carried by more than one row in a thousand, of which there can be at most a
    thousand, are served by broadcast. The other keys are served by a shuffled join in
    which the rows already served are spread by ``spread_by``, so no task gets a hot key.
    ``total`` is the number of rows if known, else the weights are summed.
    """
    values = [c for c in table.columns if c not in (*keys, weight)]
    if total is None:
        total = table.agg(F.sum(weight)).scalar()
    limit = F.floor((F.lit(total) if isinstance(total, int) else total) / HEAVY_SHARE)
    heavy = table.filter(F.col(weight) > limit).selectExpr(
        *keys, "TRUE AS is_heavy", *[f"`{c}` AS `heavy_{c}`" for c in values])
    light = table.filter(F.col(weight) <= limit).selectExpr(
        *keys, "0L AS spread", *[f"`{c}` AS `light_{c}`" for c in values])
    served = rows.join(F.broadcast(heavy), keys, "left").withColumn(
        "spread", F.expr(f"IF(is_heavy IS NULL, 0L, 1L + pmod(xxhash64({spread_by}), {SPREAD}L))"))
    joined = served.join(light, [*keys, "spread"], "left")
    found = [f"coalesce(`heavy_{c}`, `light_{c}`) AS `{c}`" for c in values]
    return joined.selectExpr(*[f"`{c}`" for c in rows.columns], *found)
