"""Quality filters: every row gets the first reason for which it fails, or "ok"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FilterConfig
from ..functions import text as T

OK = "ok"


def text_reason(cleaned: Column, config: FilterConfig = FilterConfig()) -> Column:
    """The first rule that a cleaned text fails. Null is taken for an empty text. The text and its number of words are
    computed once, and no rule is looked at behind the one that failed."""

    def by_count(text: Column, count: Column) -> Column:
        reason = F.when(count < config.min_word_count, "too_few_words").when(count > config.max_word_count, "too_many_words").when(T.is_spam(text), "spam_pattern")
        if config.check_repeated_ngrams:
            reason = reason.when(T.has_repeated_ngrams(text), "repeated_ngrams")
        return reason.otherwise(OK)

    def by_size(text: Column) -> Column:
        size = F.length(text)
        return F.when(size < config.min_text_len, "too_short").when(size > config.max_text_len, "too_long").otherwise(T.bound(T.count_words(text), lambda count: by_count(text, count)))

    return T.bound(F.coalesce(cleaned, F.lit("")), by_size)


def image_reason(width: Column, height: Column, config: FilterConfig = FilterConfig()) -> Column:
    """On the original size: too small on a side, or too long and thin. Unknown sizes are too small."""
    small = (F.coalesce(width, F.lit(0)) < config.min_image_size) | (F.coalesce(height, F.lit(0)) < config.min_image_size)
    ratio = F.greatest(width, height) / F.least(width, height)
    return F.when(small, "image_too_small").when(ratio > config.max_aspect_ratio, "bad_aspect_ratio").otherwise(OK)


def score_passes(score: Column, least: float) -> Column:
    """NaN and null fail."""
    return F.coalesce((score >= least) & ~F.isnan(score), F.lit(False))


def language_passes(lang: Column, allowed: tuple[str, ...] = ("en", "zh-cn", "zh-tw")) -> Column:
    """A language that is not known passes. An empty list means the default one."""
    return F.coalesce(lang.isin(*(allowed or ("en", "zh-cn", "zh-tw"))), F.lit(True))


def quality_stages(df: DataFrame, config: FilterConfig = FilterConfig(), caption: str = "caption", width: str | None = "width", height: str | None = "height", score: str | None = None, cleaned: Column | None = None) -> DataFrame:
    """df with `stage` and `reason`: the first failing stage of text, image and score ("" and "ok" where none).

    The caption itself is kept as it is; cleaning serves the text rules only. Stages whose column is None are left out.
    """
    text = text_reason(T.clean_text(F.col(caption)) if cleaned is None else cleaned, config)
    out = df.withColumn("_text", text)
    image = image_reason(F.col(width), F.col(height), config) if width and height else F.lit(OK)
    stage = F.when(F.col("_text") != OK, "text").when(F.col("_image") != OK, "image")
    reason = F.when(F.col("_text") != OK, F.col("_text")).when(F.col("_image") != OK, F.col("_image"))
    if config.use_clip_filter and score:
        low = ~score_passes(F.col(score), config.min_clip_score)
        stage, reason = stage.when(low, "clip"), reason.when(low, "low_clip_score")
    return out.withColumn("_image", image).withColumn("stage", stage.otherwise("")).withColumn("reason", reason.otherwise(OK)).drop("_text", "_image")


def passed(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("reason") == OK).drop("stage", "reason")


def quality_stats(staged: DataFrame) -> DataFrame:
    """One row: total, passed, failed_text, failed_image, failed_clip."""
    counts = [F.count_if(F.col("stage") == s).alias(n) for s, n in (("", "passed"), ("text", "failed_text"), ("image", "failed_image"), ("clip", "failed_clip"))]
    return staged.agg(F.count(F.lit(1)).alias("total"), *counts)


def reason_counts(staged: DataFrame) -> DataFrame:
    return staged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
