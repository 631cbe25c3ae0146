"""Smoothed character n-gram models over hashed tables of fixed size, trained by one pass over a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = (16, 20, 21)  # bits of the tables of single characters, pairs and triples
MASS = (1e-7, 60.0, 12.0)  # floor of a character, and how much the shorter context counts in the longer one
START = 2  # the code that stands before a text


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts laid end to end, two START before each, and where each text begins."""
    pad = chr(START) * 2
    joined = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(t) + 2 for t in texts])
    return joined, np.cumsum(sizes) - sizes


def slots(codes: np.ndarray) -> list[np.ndarray]:
    """Table slots of the 1-, 2- and 3-grams that end at each character."""
    one = (codes ^ (codes >> np.uint64(16))) << np.uint64(48)  # a slot of its own for each common character
    two, three = mix(codes), mix(codes)
    two[1:] = mix(codes[1:] | (codes[:-1] << np.uint64(21)))
    three[2:] = mix(codes[2:] | (codes[1:-1] << np.uint64(21)) | (codes[:-2] << np.uint64(42)))
    return [(h >> np.uint64(64 - b)).astype(np.int64) for h, b in zip((one, two, three), BITS)]


class CharModel:
    """P(c | two characters before), from counts of hashed n-grams; shorter contexts smooth longer ones."""

    def __init__(self, counts: list[np.ndarray]):
        self.counts = [c.astype(np.float32) for c in counts]
        self.total = float(max(1, self.counts[0].sum()))

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        s = slots(codes)
        n1, n2, n3 = (c[i] for c, i in zip(self.counts, s))
        before1, before2 = np.ones(len(codes), np.float32), np.ones(len(codes), np.float32)
        before1[1:], before2[1:] = n1[:-1], n2[:-1]
        p = n1 / self.total + MASS[0]
        p = (n2 + MASS[1] * p) / (before1 + MASS[1])
        p = (n3 + MASS[2] * p) / (before2 + MASS[2])
        return np.log(np.minimum(p, 1))

    def score(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each text."""
        if not texts:
            return np.zeros(0)
        codes, starts = codes_of(texts)
        each = self.log_probabilities(codes)
        each[codes == START] = 0
        return np.add.reduceat(each, starts)


def count_ngrams(texts: DataFrame, clean: Callable[[list[str]], list[str]]) -> list[np.ndarray]:
    """Counts of the n-grams of all texts (one string column) that `clean` lets through; three tables of fixed size.

    Each partition sums up its own tables; at most the sum of all slots comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(1 << b, np.int64) for b in BITS]
        for batch in batches:
            values = [t for t in batch.column(0).to_pylist() if t]
            for at in range(0, len(values), 4000):
                if not (kept := clean(values[at : at + 4000])):
                    continue
                codes, _ = codes_of(kept)
                for table, slot in zip(tables, slots(codes)):
                    table += np.bincount(slot, minlength=len(table))
        base = 0
        for table in tables:
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array((used + base).astype(np.int32)), pa.array(table[used])], ["slot", "n"])
            base += len(table)

    found = texts.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").cast("float").alias("n")).toArrow()
    flat = np.zeros(sum(1 << b for b in BITS), np.float32)
    flat[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return np.split(flat, np.cumsum([1 << b for b in BITS])[:-1])
