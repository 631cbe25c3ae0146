"""The queries of the corpus operators: (spark, sf_dir) -> DataFrame, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from . import bpe, canon, encoding, language, neardup, packing, rawdup, residue, spans, truncation
from .common import table, with_ids

Query = Callable[[SparkSession, str], DataFrame]


def _texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts are worth moving to all cores where its file has fewer row groups than there are."""
    return spread(table(spark, sf_dir, name))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, refs = _texts(spark, sf_dir, "pairs"), table(spark, sf_dir, "lang_refs")
    values = truncation.prepared(pairs)

    def left_out(ids: DataFrame) -> DataFrame:
        """Cut and garbled captions don't count: their models see all rows, but only rows of pairs are judged."""
        trained = encoding.train(values.where("clean").select(F.coalesce("raw", "text")), refs, sure=True)
        rows = with_ids(pairs.select("pair_id", "caption"), ids, "pair_id")
        garbled = encoding.repaired(rows, refs, trained=trained).where("garbled").select("id")
        cut = truncation.truncated(pairs, refs, rows=ids, residue=residue.train(pairs), values=values).where("cut").select("id")
        return garbled.union(cut)

    captions = neardup.near_captions(values, "id", "text", leave_out=left_out, tidy=False)
    images = neardup.near_hashes(table(spark, sf_dir, "images"))
    named = [df.select(F.lit(field).alias("field"), "id_a", "id_b") for field, df in (("caption", captions), ("image", images))]
    return named[0].unionByName(named[1])


def p1_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pictures' part of p1_found alone."""
    return neardup.near_hashes(table(spark, sf_dir, "images"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(spark, sf_dir).where("cut").select(F.col("id").alias("pair_id"))


def p2_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts: captions, cut ones and their share."""
    counts = _cut(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("captions"), F.count_if("cut").alias("cut"))
    return counts.withColumn("share", F.col("cut") / F.col("captions"))


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _texts(spark, sf_dir, "pairs")
    return truncation.truncated(pairs, table(spark, sf_dir, "lang_refs"), residue=residue.train(pairs))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.same_look(_texts(spark, sf_dir, "pairs")).select(F.col("id_a").alias("pair_id_a"), F.col("id_b").alias("pair_id_b"))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.canonical(_texts(spark, sf_dir, "pairs"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_scores(spark, sf_dir).where("residue").select("pair_id")


def p4_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.scored(_texts(spark, sf_dir, "pairs")).withColumnRenamed("id", "pair_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_restored(spark, sf_dir).where("garbled").select("pair_id")


def p5_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoding.repaired(_texts(spark, sf_dir, "pairs"), table(spark, sf_dir, "lang_refs"))
    return found.select(F.col("id").alias("pair_id"), "garbled", "restored")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rawdup.copies(_texts(spark, sf_dir, "raw_lines"))


def p6_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rawdup.collapsed(_texts(spark, sf_dir, "raw_lines"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_parts(spark, sf_dir).where("wrong").select("pair_id", "lang").distinct()


def p7_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _texts(spark, sf_dir, "pairs")
    parts = language.languages(pairs, table(spark, sf_dir, "lang_refs"), residue=residue.train(pairs))
    return parts.withColumnRenamed("id", "pair_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(_texts(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_texts(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_spans(_texts(spark, sf_dir, "documents")).select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(_texts(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_pictures, p2_found, p2_sources, p3_found, p3_canonical, p4_found, p4_scores, p5_found, p5_restored, p6_found, p6_collapsed, p7_found, p7_parts, p8_ids, p9_containers, p10_found, p10_share)}
