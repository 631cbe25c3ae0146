"""The whole curation: load, filter, remove duplicates, augment, write, with a count for each stage."""

from __future__ import annotations

import importlib
import inspect
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FilterConfig, PipelineConfig
from ..functions.hashing import image_hash
from ..operators import augment as A
from ..operators import dedup as D
from ..operators import quality as Q
from ..operators.scoring import ImageTextScorer, score_rows
from ..session import cut_lineage, setup_logging
from ..sources.jsonl import read_jsonl


@dataclass
class Result:
    rows: DataFrame
    stats: dict


def run_stages(df: DataFrame, config: PipelineConfig, order: str, caption: str = "caption", hash_col: str | None = None, width: str | None = None, height: str | None = None, score: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept rows, one row of counts) of filter and duplicate removal. No row leaves the cluster."""
    staged = cut_lineage(Q.quality_stages(df, config.filter, caption, width, height, score))
    good = Q.passed(staged)
    filter_stats = Q.quality_stats(staged).withColumnRenamed("total", "loaded")
    if config.run_dedup:
        marked = cut_lineage(D.dedup_stages(good, order, caption, image_hash=hash_col, image_threshold=config.dedup_image_threshold, text_threshold=config.dedup_text_threshold))
        kept, dedup_stats = marked.where("dup = 'kept'").drop("dup"), D.dedup_stats(marked).drop("total")
    else:
        kept = good
        dedup_stats = good.agg(*[F.lit(0).cast("bigint").alias(n) for n in ("exact_dup", "image_dup", "text_dup")], F.count(F.lit(1)).alias("kept"))
    return kept, filter_stats.crossJoin(dedup_stats)  # one row each


def augmented(kept: DataFrame, config: PipelineConfig, order: str, caption: str = "caption", translator: Callable | None = None) -> DataFrame:
    if not config.run_augmentation:
        return kept
    if config.augmentation_use_back_translation and translator is None:
        raise ValueError("augmentation_use_back_translation needs a translator")
    options = {"use_templates": config.augmentation_use_templates, "use_synonyms": config.augmentation_use_synonyms, "templates": config.augmentation_templates, "p": config.augmentation_synonym_p, "seed": config.augmentation_seed}
    return A.augment(kept, caption, order, translator if config.augmentation_use_back_translation else None, **options)


def load_hook(spec: str) -> Callable:
    """The object that "package.module:name" names."""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def scored(records: DataFrame, config: FilterConfig, scorer: Callable[..., ImageTextScorer] | None, width: str | None, height: str | None, device: str = "auto", batch: int = 256) -> tuple[DataFrame, str | None]:
    """records with the column of relevance scores, and its name. Without a scorer the stored `score` of the records is
    used, where a record without one has 1.0. With one, only rows that passed the rules of text and picture are scored;
    it is called with the model's name, its weights and the device if it takes them."""
    if config.use_aesthetic_filter and "aesthetic_score" not in records.columns:
        raise ValueError("use_aesthetic_filter needs a column aesthetic_score")
    if config.use_aesthetic_filter:
        records = records.where(Q.score_passes(F.col("aesthetic_score"), config.min_aesthetic_score))
    if not config.use_clip_filter:
        return records, None
    if scorer is None:
        return records, "score"
    takes = len(inspect.signature(scorer).parameters) >= 3
    make = (lambda: scorer(config.clip_model, config.clip_pretrained, device)) if takes else scorer
    early = Q.passed(Q.quality_stages(records, config, "caption", width, height)).select("ord")
    found = score_rows(records.join(early, "ord", "left_semi"), make, batch=batch).select("ord", "clip_score")
    return records.join(found, "ord", "left"), "clip_score"


def attach_images(records: DataFrame, image_root: str, method: str, workers: int | None = None) -> DataFrame:
    """records with width, height and image_hash of their pictures; null where a picture is missing or broken."""
    spark = records.sparkSession
    found = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(image_root)
    root = F.regexp_replace(F.col("image.origin"), "^file:/+", "/")
    prefix = image_root.removeprefix("file://").rstrip("/") + "/"
    hashes = found.select(F.substr(root, F.lit(len(prefix) + 1)).alias("_image"), F.when(F.col("image.height") > 0, F.col("image.width")).alias("width"), F.when(F.col("image.height") > 0, F.col("image.height")).alias("height"), image_hash(F.col("image"), method).alias("image_hash"))
    return records.join(hashes, F.col("image") == F.col("_image"), "left").drop("_image")


def run(spark: SparkSession, config: PipelineConfig, scorer: Callable[..., ImageTextScorer] | None = None, translator: Callable | None = None) -> Result:
    """Reads config.input_path, writes config.output_path (JSON lines or Parquet, and pipeline_stats.json)."""
    began = time.time()
    setup_logging(config.log_level)
    records = read_jsonl(spark, config.input_path, config.min_score)
    width = height = hashed = None
    if config.image_root:
        records = attach_images(records, config.image_root, config.dedup_image_method)
        width, height, hashed = "width", "height", "image_hash"
    records, score = scored(records, config.filter, scorer, width, height, config.resolved_device(), config.filter.clip_batch_size)
    kept, counts = run_stages(cut_lineage(records), config, "ord", "caption", hashed, width, height, score)
    out = cut_lineage(augmented(kept, config, "ord", translator=translator))
    target = out.drop("value") if config.keep_columns else out.select("caption")
    target.write.mode("overwrite").format("json" if config.output_format == "jsonl" else "parquet").save(config.output_path.rstrip("/") + f"/output.{config.output_format}")
    c, written = counts.first().asDict(), out.count()
    stats = {
        "pipeline": {"loaded": c["loaded"], "filter_passed": c["passed"], "dedup_kept": c["kept"], "written": written, "augmented": written if config.run_augmentation else 0},
        "filter": {"total": c["loaded"], **{k: c[k] for k in ("passed", "failed_text", "failed_image", "failed_clip")}},
        "dedup": {"total": c["passed"], **{k: c[k] for k in ("exact_dup", "image_dup", "text_dup", "kept")}},
        "elapsed_seconds": time.time() - began,
    }
    spark.createDataFrame([(json.dumps(stats),)], "value string").coalesce(1).write.mode("overwrite").text(config.output_path.rstrip("/") + "/pipeline_stats.json")
    return Result(out, stats)
