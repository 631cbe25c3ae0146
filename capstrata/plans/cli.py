"""Command line: capstrata pipeline | filter | dedup | demo."""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import functions as F

from ..config import FilterConfig, PipelineConfig
from ..operators import dedup as D
from ..operators import quality as Q
from ..session import build_session, cut_lineage, setup_logging
from ..sources import jsonl as J
from . import pipeline as P

DEMO = ["Two red boats on a calm lake at dawn.", "Ok", "Click now, prizes wait behind this door", "A weathered stone bridge over a narrow river.", "see you see you see you see you see you see you see you", "雨后的山谷里有一座小木屋"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="capstrata")
    sub = top.add_subparsers(dest="command", required=True)
    whole = sub.add_parser("pipeline")
    whole.add_argument("--config", required=True)
    whole.add_argument("--input")
    whole.add_argument("--output")
    text = sub.add_parser("filter")
    near = sub.add_parser("dedup")
    for p in (text, near):
        p.add_argument("--input", required=True)
        p.add_argument("--image-root", default="")
        p.add_argument("--output", required=True)
    text.add_argument("--min-clip-score", type=float, default=0.22)
    text.add_argument("--min-text-len", type=int, default=10)
    text.add_argument("--max-text-len", type=int, default=512)
    text.add_argument("--min-word-count", type=int, default=3)
    text.add_argument("--no-clip", action="store_true")
    text.add_argument("--keep-columns", action="store_true")
    text.add_argument("--batch-size", type=int, default=256, help="rows that a scorer gets at once")
    text.add_argument("--num-workers", type=int, help="partitions that the records are spread over")
    text.add_argument("--device", default="auto", help="handed to the scorer")
    for p in (whole, text):
        p.add_argument("--scorer", help="package.module:name of what makes a scorer; without one the stored scores count")
    whole.add_argument("--translator", help="package.module:name of what makes a translator")
    text.add_argument("--log-level", default="INFO")
    near.add_argument("--image-method", choices=("phash", "dhash"), default="phash")
    near.add_argument("--image-threshold", type=int, default=5)
    near.add_argument("--text-threshold", type=int, default=3)
    sub.add_parser("demo")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    setup_logging(getattr(args, "log_level", "INFO"))
    spark = build_session()
    if args.command == "pipeline":
        config = PipelineConfig.from_yaml(args.config)
        config = replace(config, **{k: v for k, v in (("input_path", args.input), ("output_path", args.output)) if v})
        hooks = [P.load_hook(x) if x else None for x in (args.scorer, args.translator)]
        print(json.dumps(P.run(spark, config, *hooks).stats))
    elif args.command == "filter":
        config = FilterConfig(min_text_len=args.min_text_len, max_text_len=args.max_text_len, min_word_count=args.min_word_count, min_clip_score=args.min_clip_score, use_clip_filter=not args.no_clip)
        records, size = J.read_jsonl(spark, args.input), (None, None)
        records = records.repartition(args.num_workers) if args.num_workers else records
        if args.image_root:
            records, size = P.attach_images(records, args.image_root, "phash"), ("width", "height")
        device = PipelineConfig(device=args.device).resolved_device()
        records, score = P.scored(cut_lineage(records), config, P.load_hook(args.scorer) if args.scorer else None, *size, device, args.batch_size)
        staged = cut_lineage(Q.quality_stages(records, config, "caption", *size, score))
        J.write_jsonl(Q.passed(staged).drop("value", "image_hash", "clip_score"), args.output, args.keep_columns)
        print(json.dumps(Q.quality_stats(staged).first().asDict()))
    elif args.command == "dedup":
        records = J.read_jsonl_strict(spark, args.input)
        hashed = None
        if args.image_root:
            # Rows whose picture is missing or broken are left out and not counted.
            records, hashed = P.attach_images(records, args.image_root, args.image_method).where("image_hash is not null"), "image_hash"
        marked = cut_lineage(D.dedup_stages(cut_lineage(records), "ord", "caption", "key", hashed, args.image_threshold, args.text_threshold))
        J.write_lines(marked.where("dup = 'kept'"), args.output)
        print(json.dumps(D.dedup_stats(marked).first().asDict()))
    else:
        rows = spark.createDataFrame([(c,) for c in DEMO], "caption string")
        rows.withColumn("reason", Q.text_reason(F.col("caption"))).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
