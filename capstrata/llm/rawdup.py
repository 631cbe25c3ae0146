"""Problem 6: records that differ in outward form only, collapsed with their number of copies.

Each normalized field name and value is hashed, the hashes of a record are added up modulo 2**64 (a multiset hash: the
order of fields does not matter), records are grouped by the sum, and the fields of a group's members are compared with
those of its first one. Grouping and joins are by hash: no sort takes part.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MASK64, attach_group, materialize, require

_kept = re.compile(r"[\W_]+")
FIELDS = "line_id bigint, fp_hi bigint, fp_lo bigint, image string, score double, letters string"


def letters_and_digits(caption: str) -> str:
    """The letters and digits in order, with case and the way accents are stored taken away."""
    return _kept.sub("", unicodedata.normalize("NFC", unicodedata.normalize("NFC", caption).casefold()))


def parse_record(line: str | None) -> tuple[str | None, float, str] | None:
    """(image, score, letters) of a JSON object with a string caption and a numeric or absent score, else None."""
    if not line or "{" not in line:
        return None
    try:
        record = json.loads(line)
    except (ValueError, RecursionError):
        return None
    if not isinstance(record, dict) or not isinstance(caption := record.get("caption"), str):
        return None
    score = record.get("score", 1.0)
    if isinstance(score, bool) or not isinstance(score, (int, float)):
        return None
    try:
        score = float(score) + 0.0
    except OverflowError:
        return None
    if not math.isfinite(score):
        return None
    image = record.get("image")
    if image is not None and not isinstance(image, str):
        image = json.dumps(image, sort_keys=True)
    return image, score, letters_and_digits(caption)


def fingerprint(fields: dict[str, str | None]) -> tuple[int, int]:
    """Two 64-bit sums over the fields' own hashes: the same for any order of the fields."""
    high = low = 0
    for name, value in fields.items():
        pair = f"{name}\x00{'n' if value is None else 'v' + value}".encode("utf-8", "surrogatepass")
        both = xxhash.xxh3_128_intdigest(pair)
        high, low = high + (both >> 64) & MASK64, low + both & MASK64
    return tuple(x - (1 << 64) if x >> 63 else x for x in (high, low))


def _text(value: str | None) -> str | None:
    return value if value is None or value.isascii() else value.encode("utf-8", "replace").decode("utf-8")


def parsed_records(df: DataFrame, id_col: str = "line_id", line_col: str = "raw_line") -> DataFrame:
    """FIELDS of the lines that hold a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for line_id, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (found := parse_record(line)) is not None:
                    image, score, letters = _text(found[0]), found[1], _text(found[2])
                    rows.append((line_id, *fingerprint({"image": image, "score": repr(score), "caption": letters}), image, score, letters))
            columns = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["line_id", "fp_hi", "fp_lo", "image", "score", "letters"])

    return require(df, id_col, line_col).mapInArrow(run, FIELDS)


def copies(df: DataFrame, id_col: str = "line_id", line_col: str = "raw_line") -> DataFrame:
    """(first_id, copy_id): every other line of a record, with its record's smallest line id.

    Null, blank and broken lines, lines of other JSON values, and records with a NaN, null or quoted score have no
    copies. A missing image equals a missing or null one only. Repeated line ids count once. An empty table: no rows.
    """
    keys = ["fp_hi", "fp_lo"]
    rows = materialize(parsed_records(df, id_col, line_col), "records")
    marks = rows.select("line_id", *keys)
    groups = marks.groupBy(*keys).agg(F.min("line_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = attach_group(marks, groups, keys).select("line_id", "first_id", "n").distinct()
    # Only the lines that have copies bring their fields along, once, and meet those of their first line.
    members = materialize(rows.join(repeated.hint("shuffle_hash"), "line_id"), "members")
    firsts = members.where("line_id = first_id").select("first_id", *[F.col(c).alias(f"first_{c}") for c in ("image", "score", "letters")], "n").distinct()
    checked = attach_group(members.drop("n"), firsts, ["first_id"]).withColumn("same", F.expr("image <=> first_image and score = first_score and letters = first_letters"))
    alike = checked.where("same and line_id <> first_id").select("first_id", F.col("line_id").alias("copy_id"))
    # Records that share a fingerprint by accident are grouped by their fields themselves.
    fields = [*keys, "image", "score", "letters"]
    odd = checked.where("not same").select("line_id", *fields).withColumn("image", F.coalesce(F.concat(F.lit("v"), "image"), F.lit("n")))
    other = odd.join(odd.groupBy(*fields).agg(F.min("line_id").alias("first_id")).hint("shuffle_hash"), fields).where("line_id <> first_id")
    return alike.unionByName(other.select("first_id", F.col("line_id").alias("copy_id"))).distinct()


def collapsed(df: DataFrame, id_col: str = "line_id", line_col: str = "raw_line") -> DataFrame:
    """(first_id, copies): one row for each record, with the number of lines that carry it."""
    rows = parsed_records(df, id_col, line_col).withColumn("image", F.coalesce(F.concat(F.lit("v"), "image"), F.lit("n")))
    return rows.groupBy("fp_hi", "fp_lo", "image", "score", "letters").agg(F.min("line_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).select("first_id", "copies")
