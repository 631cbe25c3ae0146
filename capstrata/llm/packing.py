"""Problem 9: items packed into containers of fixed capacity by a grouping genetic algorithm on islands.

Items are spread over blocks of about BLOCK_ITEMS by a hash of their id. On each block several islands evolve their own
populations of packings; the best of each island migrate to the next one between epochs, in a shuffle. Crossover puts
well-filled containers of one parent into the other, removes containers that hold one of the same items, lets displaced
items take the place of smaller ones where a container becomes fuller, and places the rest by best fit. An island rests
when its best packing has as few containers as the sum of the sizes needs.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import count_tokens
from .common import materialize

CAPACITY = 2048
BLOCK_ITEMS = 4000
ISLANDS, EPOCHS, POPULATION, GENERATIONS, ELITE = 2, 2, 8, 60, 2

Packing = list[list[int]]


def best_fit(sizes: list[int], items: list[int], bins: Packing, capacity: int) -> Packing:
    """Each item, in the given order, goes to the fullest container that still takes it."""
    room = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in items:
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(i)
            if left > sizes[i]:
                insort(room, (left - sizes[i], k))
        else:
            bins.append([i])
            if capacity > sizes[i]:
                insort(room, (capacity - sizes[i], len(bins) - 1))
    return bins


def fitness(sizes: list[int], bins: Packing, capacity: int) -> tuple[int, float]:
    """Fewer containers first; among equals, the more uneven filling, which leaves the more room in one place."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def replace(sizes: list[int], bins: Packing, displaced: list[int], capacity: int, rng: np.random.Generator, most: int = 400) -> list[int]:
    """Displaced items take the place of one or two items of a container that they fill better, in `most` containers or
    fewer, picked at random; the items that have no place then, smaller ones on the whole."""
    free = sorted((sizes[i], i) for i in displaced)
    for k in rng.permutation(len(bins))[:most].tolist():
        if not free:
            break
        inside = bins[k]
        room = capacity - sum(sizes[i] for i in inside)
        if not room:
            continue
        best = None
        for out in [*combinations(inside, 1), *(combinations(inside, 2) if len(inside) <= 12 else ())]:
            gone = sum(sizes[i] for i in out)
            at = bisect_right(free, (gone + room, len(sizes))) - 1
            if at >= 0 and free[at][0] > gone and (best is None or free[at][0] - gone > best[0]):
                best = free[at][0] - gone, out, at, None
            if len(out) == 1 and len(free) > 1:  # two for one: the largest that fits, and the largest beside it
                first = bisect_right(free, (gone + room - free[0][0], len(sizes))) - 1
                if first > 0:
                    second = min(first - 1, bisect_right(free, (gone + room - free[first][0], len(sizes))) - 1)
                    if second >= 0 and (gain := free[first][0] + free[second][0] - gone) > 0 and (best is None or gain > best[0]):
                        best = gain, out, first, second
        if best is not None:
            _, out, first, second = best
            added = [free.pop(first)[1]] + ([free.pop(second)[1]] if second is not None else [])
            bins[k] = [i for i in inside if i not in out] + added
            for i in out:
                insort(free, (sizes[i], i))
    return [i for _, i in free]


def least_bins(sizes: list[int], capacity: int) -> int:
    """As many containers as the sum of the sizes needs at least."""
    return -(-sum(sizes) // capacity)


def crossover(sizes: list[int], mother: Packing, father: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    filled = sorted(father, key=lambda b: -sum(sizes[i] for i in b))
    injected = [b for b in filled[: max(1, len(filled) // 2)] if rng.random() < 0.5]
    taken = {i for b in injected for i in b}
    kept, displaced = [list(b) for b in injected], []
    for b in mother:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    emptiest = sorted(range(len(injected), len(kept)), key=lambda k: sum(sizes[i] for i in kept[k]))[: max(1, len(kept) // 50)]
    for k in sorted(emptiest, reverse=True):  # mutation: the emptiest containers are dissolved
        displaced += kept.pop(k)
    displaced = replace(sizes, kept, displaced, capacity, rng)
    displaced.sort(key=lambda i: (-sizes[i], i))
    return best_fit(sizes, displaced, kept, capacity)


def evolve(sizes: list[int], capacity: int, seed: int, start: list[Packing] = (), generations: int = GENERATIONS, population: int = POPULATION) -> list[Packing]:
    """A population of packings, the best first. start: packings that came from elsewhere."""
    rng = np.random.default_rng(seed)
    people = [list(map(list, p)) for p in start]
    done = least_bins(sizes, capacity)
    while len(people) < population and not (len(people) >= ELITE and min(map(len, people)) <= done):
        noise = 1 + (0.0 if not people else 0.3) * rng.random(len(sizes))
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i] * noise[i], i))
        people.append(best_fit(sizes, order, [], capacity))
    scored = sorted(((fitness(sizes, p, capacity), p) for p in people), key=lambda x: x[0], reverse=True)
    least = least_bins(sizes, capacity)
    for _ in range(generations if len(scored) > 1 else 0):
        if -scored[0][0][0] <= least:
            break
        a, b = rng.choice(len(scored), 2, replace=False)
        child = crossover(sizes, scored[min(a, b)][1], scored[max(a, b)][1], capacity, rng)
        scored.append((fitness(sizes, child, capacity), child))
        scored = sorted(scored, key=lambda x: x[0], reverse=True)[:population]
    return [p for _, p in scored]


def _rows(packing: Packing, items: pd.DataFrame, block: int, island: int, rank: int, score: tuple[int, float]) -> pd.DataFrame:
    index = np.concatenate([np.array(b) for b in packing]) if packing else np.zeros(0, int)
    number = np.repeat(np.arange(len(packing)), [len(b) for b in packing])
    out = items.iloc[index][["id", "part", "size"]].assign(item=index, bin=number, block=block, island=island, rank=rank, bins=-score[0], filled=score[1])
    return out[["block", "island", "rank", "item", "id", "part", "size", "bin", "bins", "filled"]]


_SCHEMA = "block bigint, island int, rank int, item bigint, id bigint, part int, size bigint, bin bigint, bins bigint, filled double"


def _one_epoch(capacity: int, seed: int, items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
    items = items.sort_values(["id", "part", "size"], ignore_index=True)  # each epoch numbers the items alike
    block, island = int(items.block.iloc[0]), int(items.island.iloc[0])
    sizes = items["size"].tolist()
    start: list[Packing] = []
    if len(elites):
        for _, one in elites.groupby(["came", "rank"], sort=True):
            start.append([g.item.tolist() for _, g in one.groupby("bin")])
    people = evolve(sizes, capacity, seed + block * 1009 + island, start)
    best = people[:ELITE]
    return pd.concat([_rows(p, items, block, island, k, fitness(sizes, p, capacity)) for k, p in enumerate(best)])


def _epoch(capacity: int, seed: int):
    def run(items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        return _one_epoch(capacity, seed, items, elites)

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, seed: int = 7, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """items (id, size) -> (id, part, size, container): which container each item goes to.

    An item larger than the capacity is cut into full containers and one rest, numbered by part; all others have part
    0 and stay whole. Items of size 0 or null take no room and lie in some container too. Repeated ids of one size are
    told apart by their order. Negative sizes raise an error. An empty table gives no rows. The same input and seed
    give the same packing.
    """
    clean = items.select("id", F.coalesce(F.col("size"), F.lit(0)).cast("bigint").alias("size"))
    clean = clean.withColumn("size", F.when(F.col("size") < 0, F.raise_error(F.lit("a size is negative")).cast("bigint")).otherwise(F.col("size")))
    clean = materialize(clean, "sizes")
    blocks = max(1, -(-clean.count() // block_items))
    parts = clean.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    full = parts.where(F.col("size") > capacity).select("id", "block", F.expr(f"explode(sequence(0, cast(size div {capacity} as int) - 1))").alias("part"), F.lit(capacity).cast("bigint").alias("size"))
    rest = parts.select("id", "block", F.when(F.col("size") > capacity, F.floor(F.col("size") / capacity)).otherwise(0).cast("int").alias("part"), F.when(F.col("size") > capacity, F.col("size") % capacity).otherwise(F.col("size")).alias("size"), F.col("size").alias("whole"))
    rest = rest.where(f"size > 0 or whole <= {capacity}").drop("whole")
    islands = materialize(rest.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))), "islands")
    elites = None
    for epoch in range(EPOCHS):
        grown = islands.groupBy("block", "island")
        if elites is None:
            step = grown.applyInPandas(lambda pdf: _one_epoch(capacity, seed, pdf, pdf.iloc[:0]), _SCHEMA)
        else:
            # An island keeps its own elite and receives that of the island before it.
            came = elites.withColumn("came", F.lit(0)).unionByName(elites.withColumn("came", F.lit(1)).withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int")))
            step = grown.cogroup(came.groupBy("block", "island")).applyInPandas(_epoch(capacity, seed + 31 * epoch), _SCHEMA)
        elites = materialize(step, f"elite{epoch}")
    key = F.struct(F.col("bins"), -F.col("filled"), F.col("island"), F.col("rank"))
    best = elites.groupBy("block").agg(F.min(key).alias("key")).select("block", F.col("key.island").alias("island"), F.col("key.rank").alias("rank"), F.col("key.bins").alias("bins"))
    packed = elites.drop("bins", "filled").join(best, ["block", "island", "rank"])
    numbered = packed.select("id", "part", "size", (F.col("bin") * blocks + F.col("block")).alias("container"))
    # Full parts fill a container each; these have negative numbers that no two parts share.
    number = F.row_number().over(Window.partitionBy("block").orderBy("id", "part"))
    return numbered.unionByName(full.select("id", "part", "size", (-(number * blocks + F.col("block"))).cast("bigint").alias("container")))


def pack_documents(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, part, n_tokens, container) of all documents, measured in tokens."""
    sizes = count_tokens(documents).select(F.col("doc_id").alias("id"), F.col("n_tokens").alias("size"))
    return pack(sizes, capacity).select(F.col("id").alias("doc_id"), "part", F.col("size").alias("n_tokens"), "container")
