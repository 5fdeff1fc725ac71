"""Sharding by proportional stratified interleaving, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pairpulse.llm.common import CELL_ROWS, hot_keys, numbered, ranked

N_SHARDS = 16
SEED = 20


def _hashed(docs: DataFrame, seed: int) -> DataFrame:
    """``doc_id, source, size, text_crc32`` and the hash ``_h`` that shuffles the rows.

    It is one of the id. Where more than ``HOT_ROWS`` rows share an id, texts and the
    numbers of equal rows are hashed too, so that no id fills a cell.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        "doc_id", "source", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_t"),
        F.md5(F.concat_ws("|", F.lit(seed), named)).alias("_h"))
    same = numbered(rows.withColumn("_id", F.xxhash64("_h"))
                    .withColumn("_same", F.xxhash64("_h", "source", "_t")), "_same", "_copy")
    hot = hot_keys(same, "_id")
    apart = same.join(hot, F.col("_id") == F.col("_hot"), "left")
    own = F.when(F.col("_hot").isNotNull(), F.md5(F.concat_ws("|", "_h", "_t", "_copy"))).otherwise(F.col("_h"))
    return apart.withColumn("_h", own).select("doc_id", "source", "size", "text_crc32", "_h")


def interleaved_shards(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED) -> DataFrame:
    """Place every row into one of ``n_shards`` shards that all have the mixture of sources.

    Rows are shuffled within their source by a seeded hash of ``doc_id`` (of many rows with
    one id, also of the text and a number) and ranked; the
    row of rank r among n stands at (r - 1/2) / n. Sorted by that fraction, every stretch
    of the order holds each source in proportion, and equal cuts give the shards, whose
    row counts are at most one apart.

    Returns ``doc_id, source, size, text_crc32, shard, slot``: UTF-8 bytes of the text
    plus 1 (a null text has none, and checksum 0), and the place in the shard from 0.
    A null source is a source of its own; null and repeated ids are rows like any other.
    Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    rows = _hashed(docs, seed)
    hashed = F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    in_source = ranked(rows, "source", hashed, "_h", "doc_id", "text_crc32", "size")
    total = docs.count()
    n_cells = max(1, -(-total // CELL_ROWS))
    spread = (in_source.withColumn("_f", (F.col("rank") - F.lit(0.5)) / F.col("n"))
              .withColumn("_cell", F.floor(F.col("_f") * n_cells)))
    along = (Window.orderBy("_c")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = (spread.groupBy(F.col("_cell").alias("_c")).agg(F.count("*").alias("_in"))
              .select("_c", (F.sum("_in").over(along) - F.col("_in")).alias("_before")))
    within = Window.partitionBy("_cell").orderBy(
        "_f", F.col("source").asc_nulls_first(), "_h", "doc_id", "text_crc32", "size")
    place = F.col("_before") + F.col("_at") - 1
    return (spread.withColumn("_at", F.row_number().over(within))
            .join(before, F.col("_cell") == F.col("_c"))
            .withColumn("_place", place)
            .withColumn("shard", F.expr(
                f"cast((_place * {n_shards}L) div {max(1, total)}L as int)"))
            .withColumn("slot", F.expr(
                f"_place - (shard * {total}L + {n_shards - 1}L) div {n_shards}L"))
            .select("doc_id", "source", "size", "text_crc32", "shard", "slot"))
