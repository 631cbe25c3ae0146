"""Removal of exact and near duplicates, with the first row in order always the one that stays.

Greedy removal keeps a row if no kept earlier row is within the threshold. That is the lexicographically first maximal
independent set of the graph of close rows, found in rounds: rows with no open earlier neighbour are kept, and their
later neighbours fall.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import simhash
from ..functions.text import prefix_key
from ..session import cut_lineage

BLOCK = 64


def exact_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """df with `first`: whether the row is the first of its key. One partial aggregation, no window over hot keys; the
    firsts are joined back by their order, which spreads a hot key, and by key. Rows of one key and order are all first."""
    least = df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    joined = df.join(least, (F.col(order) == F.col("_first")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn("first", F.col("_first").isNotNull()).drop("_key", "_first")


def _block_pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (src before dst) of rows (ord, hash) with equal keys, block by block."""
    by = Window.partitionBy(*keys).orderBy("ord")
    kept = rows.withColumn("_n", F.row_number().over(by)).withColumn("_next", F.lead("ord").over(by)).where("_n > 1 or _next is not null")
    blocks = kept.groupBy(*keys, F.floor((F.col("_n") - 1) / BLOCK).alias("_block")).agg(F.collect_list(F.struct("ord", "hash")).alias("_rows"))
    a, b = blocks.alias("a"), blocks.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("a._block") <= F.col("b._block")]
    return a.join(b, on).select(F.explode("a._rows").alias("x"), F.col("b._rows").alias("ys")).select("x", F.explode("ys").alias("y")).where("x.ord < y.ord")


def close_pairs(df: DataFrame, threshold: int, equal: int = 2) -> DataFrame:
    """(src, dst): pairs of distinct rows (ord, hash) whose 64-bit hashes differ in at most `threshold` bits.

    The hash is cut into threshold + `equal` parts; at least `equal` of them agree in a close pair, so each choice of
    parts is an equi-join key and none is missed. More equal parts mean longer keys and more of them.
    """
    parts = threshold + equal
    if threshold < 0 or parts > 64:
        raise ValueError(f"a threshold of 0 to {64 - equal} bits")
    edges = [64 * i // parts for i in range(parts + 1)]
    keys = []
    for tag, picked in enumerate(combinations(range(parts), equal)):
        mask = sum(((1 << edges[i + 1]) - 1) & ~((1 << edges[i]) - 1) for i in picked)
        keys.append(F.struct(F.lit(tag).alias("tag"), F.col("hash").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")).alias("bits")))
    keyed = df.select("ord", "hash", F.explode(F.array(*keys)).alias("key")).select("ord", "hash", "key.tag", "key.bits")
    close = _block_pairs(keyed, ["tag", "bits"]).where(F.bit_count(F.expr("x.hash ^ y.hash")) <= threshold)
    return close.select(F.col("x.ord").alias("src"), F.col("y.ord").alias("dst")).distinct()


def greedy_dropped(edges: DataFrame) -> DataFrame:
    """(ord): the rows that greedy removal drops, from all close pairs (src before dst). Each round is checkpointed."""
    live, fallen = cut_lineage(edges), None
    while not live.isEmpty():
        heads = live.select(F.col("src").alias("ord")).distinct().join(live.select(F.col("dst").alias("ord")).distinct(), "ord", "left_anti")
        drop = live.join(heads.select(F.col("ord").alias("src")), "src", "left_semi").select(F.col("dst").alias("ord")).distinct()
        drop = cut_lineage(drop)
        fallen = drop if fallen is None else fallen.unionByName(drop)
        live = cut_lineage(live.join(drop.select(F.col("ord").alias("dst")), "dst", "left_anti").join(drop.select(F.col("ord").alias("src")), "src", "left_anti"))
    return edges.select(F.col("dst").alias("ord")).limit(0) if fallen is None else fallen.distinct()


def greedy_near_duplicates(df: DataFrame, hash_col: str, order: str, threshold: int) -> DataFrame:
    """(order): the rows of df that greedy removal drops. Rows with a null hash are kept and drop none.

    Rows with equal hashes are collapsed first: all but the first of a hash always fall with or by it.
    """
    rows = df.where(F.col(hash_col).isNotNull()).select(F.col(order).alias("ord"), F.col(hash_col).alias("hash"))
    firsts = cut_lineage(rows.groupBy("hash").agg(F.min("ord").alias("ord")))
    dropped = greedy_dropped(close_pairs(firsts, threshold))
    repeated = rows.join(firsts.select("ord"), "ord", "left_anti").select("ord")
    return repeated.unionByName(dropped).select(F.col("ord").alias(order))


def dedup_stages(df: DataFrame, order: str, caption: str = "caption", key: str | None = None, image_hash: str | None = None, image_threshold: int = 5, text_threshold: int = 3) -> DataFrame:
    """df with `dup`: "exact", "image", "text" or "kept"; each stage works on the rows that the one before left.

    key: a column of given keys; where it is null or None, the first 40 characters of the caption stand for it.
    """
    prefix = prefix_key(F.coalesce(F.col(caption), F.lit("")))
    keyed = df.withColumn("_dedup_key", F.coalesce(F.col(key), prefix) if key else prefix)
    marked = exact_first(keyed, "_dedup_key", order).drop("_dedup_key")
    left = cut_lineage(marked.where("first").select(F.col(order).alias("_o"), F.col(caption).alias("_c"), (F.col(image_hash) if image_hash else F.lit(None).cast("bigint")).alias("_h")))
    by_image = cut_lineage(greedy_near_duplicates(left, "_h", "_o", image_threshold)) if image_hash else left.select("_o").limit(0)
    left = left.join(by_image, "_o", "left_anti").withColumn("_s", simhash(F.col("_c")))
    by_text = greedy_near_duplicates(left, "_s", "_o", text_threshold)
    fate = by_image.withColumn("_dup", F.lit("image")).unionByName(by_text.withColumn("_dup", F.lit("text")))
    out = marked.join(fate.withColumnRenamed("_o", "_fate"), F.col(order) == F.col("_fate"), "left")
    return out.withColumn("dup", F.when(~F.col("first"), "exact").otherwise(F.coalesce("_dup", F.lit("kept")))).drop("first", "_dup", "_fate")


def dedup_stats(staged: DataFrame) -> DataFrame:
    """One row: total, exact_dup, image_dup, text_dup, kept."""
    counts = [F.count_if(F.col("dup") == d).alias(n) for d, n in (("exact", "exact_dup"), ("image", "image_dup"), ("text", "text_dup"), ("kept", "kept"))]
    return staged.agg(F.count(F.lit(1)).alias("total"), *counts)
