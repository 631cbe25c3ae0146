"""Image-caption samples in tar shards, as a Spark data source: one partition for each shard."""

from __future__ import annotations

import fnmatch
import glob
import io
import logging
import tarfile

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import strip

SCHEMA = "key string, image binary, caption binary, shard string"
LEAST_CAPTION = 5


def listed(pattern: str) -> list[str]:
    """The files that a pattern names, sorted: of this machine's disk, or of the storage that an address like
    hdfs://, s3:// or file:// stands for. There only the name after the last slash may hold signs of a pattern."""
    if "://" not in pattern:
        return sorted(glob.glob(pattern))
    store, path = pafs.FileSystem.from_uri(pattern.rpartition("/")[0])
    found = store.get_file_info(pafs.FileSelector(path))
    folder, _, name = pattern.rpartition("/")
    return sorted(f"{folder}/{f.base_name}" for f in found if f.is_file and fnmatch.fnmatch(f.base_name, name))


def opened(path: str):
    """A stream of the file's bytes."""
    if "://" not in path:
        return open(path, "rb")
    store, inner = pafs.FileSystem.from_uri(path)
    return store.open_input_stream(inner)


class Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


class TarReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.pattern, self.image, self.caption = options.get("path", ""), options.get("image_key", "jpg"), options.get("caption_key", "txt")

    def partitions(self):
        return [Shard(p) for part in self.pattern.split(",") for p in listed(part)] or [Shard("")]

    def read(self, shard):
        """Samples whose members share a name up to the first dot; a broken shard ends with a warning."""
        if not shard.path:
            return
        name, sample = None, {}
        try:
            with opened(shard.path) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                for member in tar:
                    if not member.isfile():
                        continue
                    folder, _, base = member.name.rpartition("/")
                    stem, _, kind = base.partition(".")
                    stem = f"{folder}/{stem}" if folder else stem
                    if name is not None and stem != name:
                        yield (name, sample.get(self.image), sample.get(self.caption), shard.path)
                        sample = {}
                    name = stem
                    sample[kind] = tar.extractfile(member).read()
        except (tarfile.TarError, OSError, EOFError) as e:
            logging.getLogger(__name__).warning("shard %s: %s", shard.path, e)
        if name is not None:
            yield (name, sample.get(self.image), sample.get(self.caption), shard.path)


class TarShards(DataSource):
    """spark.dataSource.register(TarShards); spark.read.format("tarshards").load("shards/*.tar")"""

    @classmethod
    def name(cls):
        return "tarshards"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TarReader(self.options)


def decoded_text(raw, least: int = LEAST_CAPTION):
    """Strict UTF-8, stripped; null where it is invalid or shorter than `least` characters."""
    text = strip(F.expr(f"try_validate_utf8({raw})"))
    return F.when(F.length(text) >= least, text)


def read_shards(spark: SparkSession, path: str, image_key: str = "jpg", caption_key: str = "txt", seed: int | None = None) -> DataFrame:
    """(key, image, caption, shard): samples with a picture and a caption, in a repeatable random order if seeded."""
    spark.dataSource.register(TarShards)
    rows = spark.read.format("tarshards").options(image_key=image_key, caption_key=caption_key).load(path)
    out = rows.withColumn("caption", decoded_text("caption")).where(F.col("image").isNotNull() & F.col("caption").isNotNull())
    return out if seed is None else out.orderBy(F.xxhash64("key", F.lit(seed)))


def write_shards(rows, path: str) -> None:
    """(key, image bytes, caption) samples to one tar, for tests and examples."""
    with tarfile.open(path, "w") as tar:
        for key, image, caption in rows:
            for kind, data in (("jpg", image), ("txt", caption)):
                if data is not None:
                    info = tarfile.TarInfo(f"{key}.{kind}")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
