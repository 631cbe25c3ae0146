"""Queries of the core operators: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import FilterConfig, PipelineConfig
from .functions import hashing as H
from .functions import text as T
from .operators import augment as A
from .operators import dedup as D
from .operators import quality as Q
from .operators import scoring as S
from .plans.pipeline import augmented, run_stages
from .session import spread
from .sources.jsonl import drop_blocked, parse_lines

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pairs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _table(spark, sf_dir, "pairs").select("pair_id", *(columns or ("caption",)))


def _squeezed():
    return T.squeeze(F.coalesce(F.col("caption"), F.lit("")))


def clean_whitespace(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", T.squeeze(F.col("caption")).alias("cleaned"))


def clean_text(spark, sf_dir):
    return spread(_pairs(spark, sf_dir)).select("pair_id", T.clean_text(F.col("caption")).alias("cleaned"))


def word_count(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", T.count_words(_squeezed()).alias("n_words"))


def mostly_ascii(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", T.is_mostly_ascii(F.coalesce("caption", F.lit(""))).alias("ascii"))


def repeated_ngrams(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", T.has_repeated_ngrams(_squeezed()).alias("repeated"))


def spam_flags(spark, sf_dir):
    def flag(name: str):
        return T.bound(_squeezed(), lambda text: T.spam_flag(text, name)).alias(name)

    return _pairs(spark, sf_dir).select("pair_id", *map(flag, T.SPAM))


def digests(spark, sf_dir):
    caption = F.coalesce("caption", F.lit(""))
    return _pairs(spark, sf_dir).select("pair_id", T.md5_hex(caption).alias("md5"), T.sha256_hex(caption).alias("sha256"))


def shingle_count(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", F.size(T.shingles(F.coalesce("caption", F.lit("")))).cast("bigint").alias("n_shingles"))


def prefix_keys(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", T.prefix_key(F.coalesce("caption", F.lit(""))).alias("prefix"))


def noun_phrase(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair_id", T.noun_phrase(F.coalesce("caption", F.lit(""))).alias("phrase"))


def text_reason(spark, sf_dir):
    return spread(_pairs(spark, sf_dir)).select("pair_id", Q.text_reason(_squeezed()).alias("reason"))


def reason_funnel(spark, sf_dir):
    return text_reason(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def passing_captions(spark, sf_dir):
    return text_reason(spark, sf_dir).agg(F.count_if(F.col("reason") == Q.OK).alias("passing"))


def image_reason(spark, sf_dir):
    return _table(spark, sf_dir, "images").select("image_id", Q.image_reason(F.col("width"), F.col("height")).alias("reason"))


def score_filter(spark, sf_dir):
    return _pairs(spark, sf_dir, "score").where(Q.score_passes(F.col("score"), 0.22))


def language_filter(spark, sf_dir):
    return _pairs(spark, sf_dir, "lang").where(Q.language_passes(F.col("lang"), ("en", "zh-cn", "zh-tw")))


def blocked_images(spark, sf_dir):
    """Pairs whose picture is not on a list: that of pictures that could not be decoded."""
    broken = _table(spark, sf_dir, "images").where("phash is null").select(F.col("image").alias("url"))
    return drop_blocked(_pairs(spark, sf_dir, "image"), "image", broken).select("pair_id")


def jsonl_records(spark, sf_dir):
    lines = _table(spark, sf_dir, "raw_lines").select("line_id", "raw_line")
    return parse_lines(lines, "raw_line").select("line_id", "image", "caption", "score")


def _with_images(spark, sf_dir) -> DataFrame:
    images = _table(spark, sf_dir, "images").select("image", "width", "height", H.from_hex64(F.col("phash")).alias("image_hash"))
    return spread(_pairs(spark, sf_dir, "image", "caption", "score", "key")).join(images, "image", "left")


def quality_stats(spark, sf_dir):
    staged = Q.quality_stages(_with_images(spark, sf_dir), FilterConfig(min_clip_score=0.22), score="score", cleaned=_squeezed())
    return Q.quality_stats(staged)


def exact_dedup(spark, sf_dir):
    keyed = _pairs(spark, sf_dir, "caption", "key").withColumn("k", F.coalesce("key", T.prefix_key(F.coalesce("caption", F.lit("")))))
    return D.exact_first(keyed, "k", "pair_id").where("first").select("pair_id")


def simhash(spark, sf_dir):
    return spread(_pairs(spark, sf_dir)).select("pair_id", H.hex64(H.simhash(F.col("caption"))).alias("simhash"))


def hamming_pairs(spark, sf_dir):
    """Pictures of one size whose hashes differ, and by how many bits: neighbours in the order of their ids."""
    images = _table(spark, sf_dir, "images").where("phash is not null").select("image_id", "width", "height", H.from_hex64(F.col("phash")).alias("hash"))
    before = F.lag("hash").over(Window.partitionBy("width", "height").orderBy("image_id"))
    return images.withColumn("before", before).where("before is not null").select("image_id", H.hamming(F.col("hash"), F.col("before")).cast("bigint").alias("bits"))


def image_dedup(spark, sf_dir):
    images = _table(spark, sf_dir, "images").select("image_id", H.from_hex64(F.col("phash")).alias("hash"))
    return D.greedy_near_duplicates(images, "hash", "image_id", 5)


def text_dedup(spark, sf_dir):
    rows = spread(_pairs(spark, sf_dir)).select("pair_id", H.simhash(F.col("caption")).alias("hash"))
    return D.greedy_near_duplicates(rows, "hash", "pair_id", 3)


def dedup_funnel(spark, sf_dir):
    rows = _with_images(spark, sf_dir)
    return D.dedup_stats(D.dedup_stages(rows, "pair_id", "caption", "key", "image_hash"))


def template_augment(spark, sf_dir):
    rows = spread(_pairs(spark, sf_dir)).where("caption is not null")
    return rows.select("pair_id", F.posexplode(A.template_variants(F.col("caption"), F.col("pair_id"), 3)).alias("draw", "variant"))


def synonym_augment(spark, sf_dir):
    rows = spread(_pairs(spark, sf_dir)).where("caption is not null")
    return rows.select("pair_id", A.substitute_synonyms(F.col("caption"), F.col("pair_id")).alias("variant"))


def augmented_captions(spark, sf_dir):
    rows = _pairs(spark, sf_dir).where("caption is not null")
    return A.augment(rows, templates=2).select("pair_id", "variant", "caption")


def cosine_filter(spark, sf_dir):
    """Vectors near the centre of their label: label means are a small aggregate, joined back."""
    vectors = _table(spark, sf_dir, "embeddings")
    each = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centres = each.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))
    scored = vectors.join(centres, "label").select("vec_id", S.cosine(F.col("embedding"), F.col("centre")).alias("score"))
    return scored.where(Q.score_passes(F.col("score"), 0.05)).select("vec_id", F.round("score", 6).alias("score"))


def run_stats_latest(spark, sf_dir):
    """The last run of each shard, and what its stages kept."""
    runs = _table(spark, sf_dir, "run_stats")
    last = runs.groupBy("shard").agg(F.max_by(F.struct("run_id", "loaded", "passed", "kept"), F.struct("started_at", "run_id")).alias("r"))
    return last.select("shard", "r.run_id", "r.loaded", "r.passed", "r.kept")


def pipeline_stats(spark, sf_dir):
    config = PipelineConfig(filter=FilterConfig(min_clip_score=0.22))
    kept, counts = run_stages(_with_images(spark, sf_dir), config, "pair_id", "caption", "image_hash", "width", "height", "score")
    return counts


def pipeline_rows(spark, sf_dir):
    config = PipelineConfig(run_augmentation=True, filter=FilterConfig(min_clip_score=0.22))
    kept, _ = run_stages(_with_images(spark, sf_dir), config, "pair_id", "caption", "image_hash", "width", "height", "score")
    return augmented(kept, config, "pair_id").select("pair_id", "variant", "caption")


def queries() -> dict[str, Query]:
    named = (
        clean_whitespace, clean_text, word_count, mostly_ascii, repeated_ngrams, spam_flags, digests, shingle_count, prefix_keys, noun_phrase,
        text_reason, reason_funnel, passing_captions, image_reason, score_filter, language_filter, blocked_images, jsonl_records, quality_stats,
        exact_dedup, simhash, hamming_pairs, image_dedup, text_dedup, dedup_funnel, template_augment, synonym_augment, augmented_captions, cosine_filter,
        run_stats_latest, pipeline_stats, pipeline_rows,
    )
    return {f.__name__: f for f in named}
