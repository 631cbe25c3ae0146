"""JSON lines in and out, and lists of blocked addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

RECORD = "image string, caption string, score string, key string, _corrupt string"


def parse_lines(df: DataFrame, line: str = "value", min_score: float | None = 0.0, compat: bool = False) -> DataFrame:
    """df with image, caption, score and key of lines that hold a JSON object; blank, broken and other lines fall.

    A missing or null score counts as 1.0; a score that is no number, NaN or below min_score drops the row (None: no
    test). A missing caption is "". compat: a line that is not an object, or a score that is no number, raises.
    """
    source = df.withColumn("_r", F.from_json(F.col(line), RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "true", "allowSingleQuotes": "false"}))
    is_object = F.col(line).rlike(r"^\s*\{") & F.col("_r._corrupt").isNull()
    given = F.col("_r.score")
    score = F.when(given.isNull(), F.lit(1.0)).otherwise(F.expr("try_cast(_r.score as double)"))
    if compat:
        bad = strip(F.col(line)).rlike(r"^[\[\"0-9tfn-]") | (given.isNotNull() & score.isNull() & (given != '"NaN"'))
        source = source.withColumn("_r", F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.concat(F.lit("not a record: "), F.col(line))).cast(source.schema["_r"].dataType)).otherwise(F.col("_r")))
    out = source.where(is_object).withColumns({"image": F.col("_r.image"), "caption": F.coalesce("_r.caption", F.lit("")), "score": score, "key": F.col("_r.key")}).drop("_r")
    if min_score is not None:
        out = out.where(F.coalesce((F.col("score") >= min_score) & ~F.isnan("score"), F.lit(False)))
    return out


def read_jsonl(spark: SparkSession, path: str, min_score: float | None = 0.0, compat: bool = False) -> DataFrame:
    """Records of JSON lines, with the line itself (`value`) and an order within the scan (`ord`)."""
    lines = spark.read.text(path).withColumn("ord", F.monotonically_increasing_id())
    return parse_lines(lines, "value", min_score, compat)


def read_jsonl_strict(spark: SparkSession, path: str) -> DataFrame:
    """As read_jsonl, without a test of the score; a broken line fails the job. Blank lines are skipped."""
    lines = spark.read.text(path).withColumn("ord", F.monotonically_increasing_id()).where(strip(F.col("value")) != "")
    parsed = lines.withColumn("_r", F.from_json("value", "image string, caption string, score string, key string", {"mode": "FAILFAST", "allowSingleQuotes": "false"}))
    return parsed.select("value", "ord", "_r.image", F.coalesce("_r.caption", F.lit("")).alias("caption"), F.expr("try_cast(_r.score as double)").alias("score"), "_r.key")


def write_jsonl(df: DataFrame, path: str, keep_columns: bool = False, caption: str = "caption", order: str | None = None) -> None:
    """JSON lines, as before only the caption unless keep_columns; non-ASCII characters stay as they are."""
    out = df.orderBy(order) if order else df
    (out if keep_columns else out.select(F.col(caption).alias("caption"))).write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, line: str = "value") -> None:
    """The input lines echoed."""
    df.select(line).write.mode("overwrite").text(path)


def load_blocklist(spark: SparkSession, path: str | None) -> DataFrame:
    """(url) from a text file, trimmed, without blank lines; no rows for None or a missing file."""
    from pyspark.errors import AnalysisException

    empty = spark.createDataFrame([], "url string")
    if not path:
        return empty
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    return lines.select(strip(F.col("value")).alias("url")).where("url <> ''").distinct()


def drop_blocked(df: DataFrame, url: str, blocklist: DataFrame) -> DataFrame:
    """Rows whose url is not on the list. The optimizer broadcasts a list that it knows to be small."""
    return df.join(blocklist.select(F.col("url").alias("_blocked")), F.col(url) == F.col("_blocked"), "left_anti")


def shuffled(df: DataFrame, key: Column, seed: int = 0) -> DataFrame:
    """Rows in a random but repeatable order."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)))
