"""Sharding by vector bin packing: groups of equal texts go to shards so that bytes, tokens and rows balance jointly.

The table is dealt into buckets by the hash of the text. A bucket puts its groups, largest first, into as many bins as there are shards,
each where the dot product of the group's sizes with the bin's residual capacity is highest; then the bins of all
buckets go to the shards by the same rule. A group too large for a bin's share is split into pieces first, so a text that a
third of all rows repeat spreads over the shards. Only sizes and hashes are shuffled, never texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.sources.storage import materialise

SHARDS = 40
#: Pieces of a group hold at most this part of a shard's share of bytes.
PIECE = 16


def place(sizes: np.ndarray, bins: int, capacity: np.ndarray) -> np.ndarray:
    """Bin of each item (rows of ``sizes``: bytes, tokens, rows), largest first; ties by position.

    Sizes count as shares of a bin's capacity. An item goes where the dot product with the residual capacity is highest,
    among the bins with room in bytes for it, or among all if there is none.
    """
    share = sizes / np.maximum(capacity, 1e-9)
    left = np.ones((bins, sizes.shape[1]))
    out = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-share[:, 0], kind="stable"):
        fit = left @ share[i]
        room = left[:, 0] >= share[i, 0]
        if room.any():
            fit = np.where(room, fit, -np.inf)
        else:  # none has room: the emptiest in bytes
            fit = left[:, 0]
        out[i] = k = int(np.argmax(fit))
        left[k] -= share[i]
    return out


def assign(docs: DataFrame, shards: int = SHARDS, buckets: int | None = None, extra_bytes: int = 16) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` ('bytes'), ``shard``, ``slot``, ``grown_shard`` (null) of each row of ``docs`` (doc_id, text).

    Size: UTF-8 bytes of the text plus ``extra_bytes``. Tokens, one of the three dimensions, are counted as words. Slots are
    gapless from 0 in each shard. A null text is empty (and a group with other empty texts). Rows may repeat; null ids stay
    null; an empty table gives no rows; other columns are ignored. The driver sees ``buckets`` x ``shards`` rows of three
    numbers, whatever the number of rows; buckets are as many as shuffle partitions.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + extra_bytes).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"), F.xxhash64(text).alias("h"),
                       F.expr("xxhash64(reverse(coalesce(CAST(text AS STRING), '')))").alias("g"))
    rows = materialise(rows, "sizes")
    whole = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    capacity = np.array([max(1, x or 0) for x in whole], np.float64) / shards
    # a row's piece of its group follows from the row itself, so no group meets in one task before it is split
    counted = rows.groupBy("h", "g").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    large = counted.filter(F.col("bytes") > capacity[0] / PIECE).select(
        "h", "g", F.ceil(F.col("bytes") / (capacity[0] / PIECE)).cast("long").alias("pieces"))  # at most PIECE * shards groups
    piece = F.expr("CASE WHEN pieces IS NULL THEN 0L ELSE pmod(xxhash64(doc_id, 3), pieces) END")
    rows = rows.join(F.broadcast(large), ["h", "g"], "left").withColumn("piece", piece)
    groups = rows.groupBy("h", "g", "piece").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    groups = groups.withColumn("bucket", F.expr(f"pmod(xxhash64(h, g, piece), {buckets}L)"))

    def bins(table: pa.Table) -> pa.Table:
        order = np.lexsort([table.column(c).to_numpy() for c in ("piece", "g", "h")])
        table = table.take(pa.array(order))
        sizes = np.stack([table.column(c).to_numpy() for c in ("bytes", "tokens", "n")], 1).astype(np.float64)
        found = place(sizes, shards, np.maximum(sizes.sum(0), 1) / shards)
        return table.select(["h", "g", "piece", "bucket", "bytes", "tokens", "n"]).append_column("bin", pa.array(found))

    kinds = "h long, g long, piece long, bucket long, bytes long, tokens long, n long, bin long"
    packed = materialise(groups.groupBy("bucket").applyInArrow(bins, kinds), "bins")
    totals = packed.groupBy("bucket", "bin").agg(F.sum("bytes"), F.sum("tokens"), F.sum("n")).orderBy("bucket", "bin").collect()
    shard = place(np.array([r[2:] for r in totals], np.float64).reshape(-1, 3), shards, capacity)
    chosen = spark.createDataFrame([(r[0], r[1], int(s)) for r, s in zip(totals, shard)], "bucket long, bin long, shard int")
    # one slot range for each (shard, lane): lanes are hashes of the row, so a shard is numbered by many tasks
    placed = packed.join(F.broadcast(chosen), ["bucket", "bin"]).select("h", "g", "piece", "shard")
    put = rows.join(placed, ["h", "g", "piece"]).withColumn("lane", F.expr(f"pmod(xxhash64(doc_id, h, 5), {buckets}L)"))
    put = materialise(put.select("doc_id", "size", "text_crc32", "h", "shard", "lane"), "placed")
    lanes = put.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    first = lanes.selectExpr("shard", "lane", "sum(n) OVER (PARTITION BY shard ORDER BY lane) - n AS before")  # shards x lanes rows
    numbered = put.selectExpr("*", "row_number() OVER (PARTITION BY shard, lane ORDER BY doc_id, h) - 1 AS place").join(F.broadcast(first), ["shard", "lane"])
    return numbered.selectExpr("doc_id", "size", "text_crc32", "'bytes' AS law", "shard", "before + place AS slot", "CAST(NULL AS INT) AS grown_shard")
