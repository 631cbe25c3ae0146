import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstrata.functions import hashing as H
from capstrata.operators import dedup as D


def greedy(hashes, threshold):
    kept, dropped = [], set()
    for i, h in enumerate(hashes):
        if h is None:
            continue
        if any(((h ^ k) & (2**64 - 1)).bit_count() <= threshold for k in kept):
            dropped.add(i)
        else:
            kept.append(h)
    return dropped


def chains(seed, n):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        h = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            out.append(h - (1 << 64) if h >> 63 else h)
            for _ in range(rng.randrange(0, 4)):
                h ^= 1 << rng.randrange(64)
    return out[:n]


@pytest.mark.parametrize("seed,threshold", [(1, 3), (2, 5)])
def test_greedy_equals_the_sequential_scan(spark, seed, threshold):
    hashes = [*chains(seed, 120), None, 0, 0, -1]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(hashes)], "ord bigint, hash bigint").repartition(3)
    got = {r.ord for r in D.greedy_near_duplicates(rows, "hash", "ord", threshold).collect()}
    assert got == greedy(hashes, threshold)


def test_exact_keeps_the_first(spark):
    rows = spark.createDataFrame([(3, "k"), (1, "k"), (2, "x")], "ord bigint, key string")
    assert {(r.ord, r.first) for r in D.exact_first(rows, "key", "ord").collect()} == {(1, True), (2, True), (3, False)}


def test_stages_blame_in_order(spark):
    rows = spark.createDataFrame([(1, "a red car on a street", 0), (2, "a red car on a street", 9), (3, "green hills far away under the sky", 1), (4, "something else entirely here today", None)], "id bigint, caption string, h bigint")
    marked = D.dedup_stages(rows, "id", "caption", image_hash="h")
    assert {r.id: r.dup for r in marked.collect()} == {1: "kept", 2: "exact", 3: "image", 4: "kept"}
    assert D.dedup_stats(marked).first().asDict() == {"total": 4, "exact_dup": 1, "image_dup": 1, "text_dup": 0, "kept": 2}


def test_empty_table(spark):
    rows = spark.createDataFrame([], "ord bigint, hash bigint")
    assert D.greedy_near_duplicates(rows, "hash", "ord", 3).count() == 0


def test_simhash_distances():
    shingle = lambda t: [" ".join(t.lower().split()[i : i + 3]) for i in range(len(t.split()) - 2)]
    apart = lambda a, b: ((H.simhash_of(shingle(a)) ^ H.simhash_of(shingle(b))) & (2**64 - 1)).bit_count()
    assert apart("A brown dog runs through the park", "A brown dog runs through the garden") < 20
    assert apart("A cat is sleeping on the sofa", "Quantum computers factor large numbers quickly") > 5


def test_phash_is_the_direct_transform():
    rng = np.random.default_rng(0)
    gray = rng.integers(0, 256, (32, 32))
    n = 32
    low = [[sum(4 * gray[y, x] * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(n) for x in range(n)) for v in range(8)] for u in range(8)]
    bits = (np.array(low) > np.median(low)).ravel()
    want = int("".join("1" if b else "0" for b in bits), 2)
    assert H.phash_of(gray) & (2**64 - 1) == want


def test_dhash_of_a_ramp():
    assert H.dhash_of(np.tile(np.arange(90), (80, 1))) == -1
    assert H.dhash_of(np.zeros((8, 9))) == 0


def test_first_of_key_with_equal_orders(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), (None, 2), (None, 3)], "k string, o int")
    got = {(r.k, r.o): r.first for r in D.exact_first(rows, "k", "o").collect()}
    assert got == {("a", 1): True, ("b", 1): True, ("a", 2): False, (None, 2): True, (None, 3): False}
