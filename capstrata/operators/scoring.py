"""Relevance scores of image and caption: from stored vectors, or from a model behind an interface."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


class ImageTextScorer(Protocol):
    """Scores rows of pictures (paths or bytes) and captions; made once for each task."""

    def __call__(self, images: list, captions: list[str]) -> list[float]: ...


class LanguageDetector(Protocol):
    """A language code for each text; it may raise, and then the row passes."""

    def __call__(self, texts: list[str]) -> list[str | None]: ...


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Of two vectors of one length; NaN where a norm is 0."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(float("nan")))


def score_rows(df: DataFrame, scorer: Callable[[], ImageTextScorer], image: str = "image", caption: str = "caption", batch: int = 256) -> DataFrame:
    """df with `clip_score`. The scorer is made once per task; rows reach it in batches."""
    schema = StructType([*df.schema.fields, StructField("clip_score", DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer()
        for frame in frames:
            images, captions = frame[image].tolist(), frame[caption].fillna("").tolist()
            yield frame.assign(clip_score=[float(s) for at in range(0, len(frame), batch) for s in score(images[at : at + batch], captions[at : at + batch])])

    return df.mapInPandas(run, schema)


def detect_language(df: DataFrame, detector: Callable[[], LanguageDetector], caption: str = "caption") -> DataFrame:
    """df with `detected`: null where the detector failed, so that the row passes the language filter."""
    from pyspark.sql.types import StringType

    schema = StructType([*df.schema.fields, StructField("detected", StringType())])

    def one(detect: LanguageDetector, text: str) -> str | None:
        try:
            return detect([text])[0]
        except Exception:
            return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = detector()
        for frame in frames:
            texts = [text or "" for text in frame[caption].tolist()]
            try:
                found = list(detect(texts))
            except Exception:  # one bad text must not lose the batch
                found = [one(detect, text) for text in texts]
            yield frame.assign(detected=found)

    return df.mapInPandas(run, schema)
