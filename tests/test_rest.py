import json
import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from capstrata.config import FilterConfig, PipelineConfig
from capstrata.functions.image import tensor
from capstrata.operators import augment as A
from capstrata.operators import scoring as S
from capstrata.plans import cli
from capstrata.plans import pipeline as P
from capstrata.sources import jsonl as J
from capstrata.sources import tarshards as W
from capstrata.streaming import stages as ST


def png(path, width, height, shade):
    raw = b"".join(b"\x00" + bytes((shade * (x + 1) * (y + 3)) % 251 for x in range(width)) for y in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_lines_that_are_no_records_fall(spark):
    lines = ['{"image":"a","caption":"x","score":0.5}', '{"caption":"y"}', '{"caption":"z","score":"0.5"}', '{"caption":"n","score":NaN}', '{"caption":"m","score":-1}', '{"caption":"w","score":"x"}', "", "5", "[{}]", "{broken", None]
    rows = spark.createDataFrame([(t,) for t in lines], "value string")
    assert [(r.caption, r.score) for r in J.parse_lines(rows).collect()] == [("x", 0.5), ("y", 1.0), ("z", 0.5)]


def test_blocklist(spark, tmp_path):
    (tmp_path / "list.txt").write_text(" http://a \n\nhttp://b\n")
    rows = spark.createDataFrame([("http://a",), ("http://c",), (None,)], "url string")
    kept = J.drop_blocked(rows, "url", J.load_blocklist(spark, str(tmp_path / "list.txt")))
    assert {r.url for r in kept.collect()} == {"http://c", None}
    assert J.load_blocklist(spark, None).count() == 0 and J.load_blocklist(spark, str(tmp_path / "none")).count() == 0


def test_tar_shards(spark, tmp_path):
    W.write_shards([("a", b"1", "  a cat here ".encode()), ("b", b"2", b"cat"), ("c", None, b"no picture"), ("d", b"4", b"\xff\xfe\xfd\xfc\xfb")], str(tmp_path / "s.tar"))
    (tmp_path / "t.tar").write_bytes(b"not a tar")
    got = W.read_shards(spark, str(tmp_path / "*.tar"), seed=1).collect()
    assert [(r.key, r.caption, bytes(r.image)) for r in got] == [("a", "a cat here", b"1")]


def test_augmentation(spark):
    rows = spark.createDataFrame([(1, "A large dog, standing."), (2, ""), (3, None)], "pair_id bigint, caption string")
    out = A.augment(rows, templates=3).collect()
    assert {r.caption for r in out if r.pair_id == 1 and r.variant == 0} == {"A large dog, standing."}
    assert not [r for r in out if r.pair_id == 3]
    all_words = rows.where("pair_id = 1").select(A.substitute_synonyms(F.col("caption"), F.col("pair_id"), p=1.0).alias("v")).first().v
    first, last = all_words.split()[1], all_words.rsplit(" ", 1)[-1]
    assert first in A.SYNONYMS["large"] and all_words.endswith(".") and last != "standing."


def test_back_translation_keeps_rows_on_failure(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "caption string")

    def broken():
        def run(texts, source, target):
            raise RuntimeError("no model")

        return run

    assert [r.back for r in A.back_translate(rows, broken).collect()] == [None, None]
    assert {r.back for r in A.back_translate(rows, lambda: lambda texts, s, t: [x + t for x in texts]).collect()} == {"azhen", "bzhen"}


def test_scores(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r[0] for r in rows.select(S.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] != got[1]
    scored = S.score_rows(spark.createDataFrame([("i", "c")], "image string, caption string"), lambda: lambda images, captions: [0.25] * len(images))
    assert scored.first().clip_score == 0.25
    assert S.detect_language(spark.createDataFrame([("x",)], "caption string"), lambda: lambda texts: ["en"]).first().detected == "en"


def test_translated_variant_and_options_from_config(spark):
    rows = spark.createDataFrame([(1, "A dog"), (2, None)], "pair_id bigint, caption string")
    config = PipelineConfig(run_augmentation=True, augmentation_use_back_translation=True, augmentation_templates=4, augmentation_seed=7)
    with pytest.raises(ValueError):
        P.augmented(rows, config, "pair_id")
    out = P.augmented(rows, config, "pair_id", translator=lambda: lambda texts, s, t: [x + "!" for x in texts]).collect()
    assert max(out, key=lambda r: r.variant).caption == "A dog!!" and {r.pair_id for r in out if r.variant == 0} == {1}
    assert len({r.variant for r in out if r.pair_id == 1}) == len([r for r in out if r.pair_id == 1])


def test_stored_scores_count_without_a_scorer(spark, tmp_path):
    lines = [{"image": "a", "caption": "A dog playing in the park.", "score": s} for s in (0.1, 0.5)] + [{"image": "b", "caption": "Two boats on a calm lake."}]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{'image':'c','caption':'single quotes are no JSON'}\n")
    assert cli.main(["filter", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "f"), "--keep-columns", "--num-workers", "2"]) == 0
    assert sorted(r.score for r in spark.read.json(str(tmp_path / "f")).collect()) == [0.5, 1.0]
    config = PipelineConfig(input_path=str(tmp_path / "in.jsonl"), output_path=str(tmp_path / "o"), output_format="parquet", run_dedup=False)
    stats = P.run(spark, config, scorer=lambda model, weights, device: lambda images, captions: [0.3 if model and c.startswith("Two") else 0.0 for c in captions]).stats
    assert stats["filter"]["failed_clip"] == 2 and spark.read.parquet(str(tmp_path / "o/output.parquet")).count() == 1
    with pytest.raises(ValueError):
        P.run(spark, PipelineConfig(input_path=str(tmp_path / "in.jsonl"), filter=FilterConfig(use_aesthetic_filter=True)))


def test_shards_by_address(spark, tmp_path):
    W.write_shards([("k1", b"x", "a first caption".encode()), ("k2", b"y", b"tiny")], str(tmp_path / "s1.tar"))
    W.write_shards([("k3", b"z", "another caption".encode())], str(tmp_path / "s2.tar"))
    for pattern in (f"{tmp_path}/s*.tar", f"file://{tmp_path}/s*.tar"):
        assert {r.key for r in W.read_shards(spark, pattern).collect()} == {"k1", "k3"}


def test_detector_that_fails_on_one_text(spark):
    def detect(texts):
        if "bad" in texts:
            raise RuntimeError
        return ["en"] * len(texts)

    got = S.detect_language(spark.createDataFrame([("a",), ("bad",)], "caption string").coalesce(1), lambda: detect).collect()
    assert {r.caption: r.detected for r in got} == {"a": "en", "bad": None}


def test_config_round_trip(tmp_path):
    config = PipelineConfig(input_path="x", filter=FilterConfig(min_text_len=5))
    config.to_yaml(str(tmp_path / "c.yaml"))
    assert PipelineConfig.from_yaml(str(tmp_path / "c.yaml")) == config
    with pytest.raises(TypeError):
        PipelineConfig.from_dict({"unknown": 1})
    with pytest.raises(TypeError):
        PipelineConfig.from_dict({"filter": None})


def test_tensor_shape():
    import numpy as np

    bgr = np.zeros((300, 260, 3), np.uint8)
    assert tensor(bgr).shape == (3, 224, 224) and tensor(bgr, seed=1).shape == (3, 224, 224)


def test_whole_pipeline(spark, tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    png(images / "a.png", 100, 100, 3)
    png(images / "b.png", 100, 100, 3)
    png(images / "small.png", 20, 20, 5)
    lines = [
        {"image": "a.png", "caption": "A dog playing in the park on a sunny afternoon."},
        {"image": "b.png", "caption": "Two red boats resting on a calm lake at dawn."},
        {"image": "small.png", "caption": "A tiny picture of a mountain under clouds."},
        {"image": "a.png", "caption": "Hi"},
    ]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, lines)))
    config = PipelineConfig(input_path=str(tmp_path / "in.jsonl"), output_path=str(tmp_path / "out"), image_root=str(images), filter=FilterConfig(use_clip_filter=False))
    stats = P.run(spark, config).stats
    assert stats["filter"] == {"total": 4, "passed": 2, "failed_text": 1, "failed_image": 1, "failed_clip": 0}
    assert stats["dedup"] == {"total": 2, "exact_dup": 0, "image_dup": 1, "text_dup": 0, "kept": 1}
    assert spark.read.json(str(tmp_path / "out/output.jsonl")).count() == 1


def test_cli_filter_then_dedup_keeps_images(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"image":"a","caption":"A dog playing in the park."}\n{"image":"b","caption":"Hi"}\n')
    assert cli.main(["filter", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "f"), "--no-clip", "--keep-columns"]) == 0
    assert [r.image for r in spark.read.json(str(tmp_path / "f")).collect()] == ["a"]
    assert cli.main(["dedup", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "d")]) == 0
    assert spark.read.text(str(tmp_path / "d")).count() == 2


def test_streams(spark, tmp_path):
    spark.createDataFrame([("A dog playing in the park.", 1), ("A dog playing in the park.", 2), ("Hi", 3)], "caption string, s int").withColumn("ts", F.timestamp_seconds("s")).drop("s").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("caption string, ts timestamp").parquet(str(tmp_path / "in"))
    out = ST.first_of_keys(ST.filter_stream(stream), "ts", "1 hour")
    query = out.writeStream.format("memory").queryName("firsts").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.reason for r in spark.sql("select * from firsts").collect()) == ["ok", "too_short"]


def test_entry_needs_no_session_to_import():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and time
