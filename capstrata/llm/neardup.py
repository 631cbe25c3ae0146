"""Problem 1: near-identical captions and pictures among more rows than could be compared two by two.

Captions: every word has a region whose width is its weight, the less the more records hold the word. Hashed darts are
thrown into the regions, the same for all records; a record keeps its earliest darts, and records are joined by the darts
they keep. A fixed number of coordinates with bands over them would find a pair with some chance only, and hardly ever
one whose rare words differ. So the number of darts kept follows from the sizes instead: two records whose share of
common words is at least the given one have, among the words of the earlier darts of either, at most as many as the other
lacks; that bounds how late their first common dart can be, for each class of sizes a partner may have. All pairs meet
under one of these darts; a bitmap of the words (which loses none) and then the words themselves decide.

Pictures: two 64-bit hashes within 5 bits leave some parts of the hash equal, which is a join key that loses none;
a sampled signature of darts would lose pairs at the limit, which is why darts aren't used there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .canon import repair
from .chars import mix
from .common import attach_group, exchange, materialize, pair_rows, require, with_ids

MIN_WORDS, SIMILARITY = 8, 0.7
WORD_BYTES = 5  # of a word's hash
DF_BITS = 24  # the table of document frequencies has 2**DF_BITS entries of a byte at any size of the input
SALT_ROWS = 65_536  # records with a word, or members of a class, that are kept together under a key
PART_ROWS = 120_000  # records whose keys one task receives, about
BLOCK_PAIRS = 1 << 22  # pairs that are compared at once
DENSE = 16_384  # hashes under one key beyond which the key is refined

_find_words = re.compile(r"[^\W_]+").findall


def words_of(text: str, tidy: bool = True) -> set[str]:
    """Distinct maximal runs of letters or digits, in lower case, of the text's consistent form."""
    return set(_find_words((repair(text) if tidy else text).lower()))


def hash_words(words) -> np.ndarray:
    """Hashes of WORD_BYTES bytes of the words, in the upper bits of 64, sorted."""
    hashes = _hashed(words, len(words))
    hashes.sort()
    return hashes


def _hashed(words, n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n) & np.uint64(2**64 - 2 ** (64 - 8 * WORD_BYTES))


def _packed(flat: np.ndarray) -> bytes:
    return flat.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def _unpacked(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the sets of a binary column, and their words' hashes end to end."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(words) else np.zeros(0, np.uint8)
    flat = np.zeros((len(data) // WORD_BYTES, 8), np.uint8)
    flat[:, :WORD_BYTES] = data.reshape(-1, WORD_BYTES)
    return np.diff(offsets).astype(np.int64) // WORD_BYTES, flat.reshape(-1).view(">u8").astype(np.uint64)


def caption_sets(df: DataFrame, id_col: str, text_col: str, tidy: bool = True) -> DataFrame:
    """(id, key_a, key_b, words): captions with MIN_WORDS distinct words or more, as sorted hashes of the words. tidy:
    whether the texts are still to be brought into one form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sets = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text is not None and len(text) >= 2 * MIN_WORDS - 1 and len(words := words_of(text, tidy)) >= MIN_WORDS:
                    kept.append(i)
                    sets.append(words)
            sizes = np.array([len(w) for w in sets], np.int64)
            starts = np.cumsum(sizes) - sizes
            flat = _hashed(chain.from_iterable(sets), int(sizes.sum()))
            flat = flat[np.lexsort((flat, np.repeat(np.arange(len(sets)), sizes)))]
            keys = [np.add.reduceat(mix(flat ^ np.uint64(salt)), starts) if len(sets) else flat for salt in (1, 2)]
            words = pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer((np.append(starts, len(flat)) * WORD_BYTES).astype(np.int32)), pa.py_buffer(_packed(flat))])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), *[pa.array(k.view(np.int64)) for k in keys], words], ["id", "key_a", "key_b", "words"])

    return require(df, id_col, text_col).mapInArrow(run, "id bigint, key_a bigint, key_b bigint, words binary")


_COUNT = np.dtype([("slot", "<u4"), ("n", "<u4")])
#: What a byte of the table stands for: counts up to 16 as they are, larger ones by eighths of a doubling, rounded up.
_ABOUT = np.concatenate([np.arange(17), np.ceil(16 * 2 ** (np.arange(1, 239) / 8))]).astype(np.int64)


class StoredCounts:
    """How many records hold a word of each slot, by the files of a byte for each slot, which each worker reads once."""

    _last: tuple[tuple, np.ndarray] | None = None

    def __init__(self, files: list[str]):
        self.files = tuple(sorted(files))

    def load(self) -> np.ndarray:
        if StoredCounts._last is None or StoredCounts._last[0] != self.files:
            table = np.zeros(1 << DF_BITS, np.uint8)
            for name in self.files:
                fs, path = pafs.FileSystem.from_uri(name)
                with fs.open_input_file(path) as f:
                    for first, data in zip(*(c.to_pylist() for c in pq.read_table(f).columns)):
                        table[first : first + len(data)] = np.frombuffer(data, np.uint8)
            StoredCounts._last = self.files, table
        return StoredCounts._last[1]


def word_counts(sets: DataFrame, parts: int) -> StoredCounts:
    """Over all records; the counts are summed in parts and never meet in the driver."""
    width = -(-(1 << DF_BITS) // parts)

    def make(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            slot, n = np.unique((_unpacked(batch.column(0))[1] >> np.uint64(64 - DF_BITS)).astype(np.uint32), return_counts=True)
            rows = np.empty(len(slot), _COUNT)
            rows["slot"], rows["n"] = slot, n
            yield slot // np.uint32(width), rows

    def take(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = int(rows["slot"][0]) // width * width
        # The last part is narrower where parts don't divide the table.
        total = np.bincount(rows["slot"] - np.uint32(first), rows["n"], min(width, (1 << DF_BITS) - first)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([np.searchsorted(_ABOUT, total).astype(np.uint8).tobytes()], pa.binary())], ["first", "data"])

    return StoredCounts(materialize(exchange(sets.select("words"), make, take, parts, _COUNT, "first bigint, data binary"), "counts").inputFiles())


def first_darts(words: np.ndarray, count: np.ndarray) -> np.ndarray:
    """When the first dart of each word falls: darts fall evenly, into a region as wide as the word's weight, 1 / count.
    The time of the first one has an exponential distribution, and is drawn from the word's hash."""
    even = (mix(words + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) + 1
    return -np.log(even / (2.0**53 + 1)) * count


def _size_classes() -> np.ndarray:
    """Where the classes of sizes begin: each a quarter more than the one before, as narrower ones make more keys."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * 1.25)))
    return np.array(out)


_CLASSES = _size_classes()


def prefix_keys(ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray, counts: np.ndarray, similarity: float, larger: bool) -> tuple[np.ndarray, np.ndarray]:
    """(record, key): the darts under which each record meets records of larger classes of sizes, or as the larger one.

    Two sets with the given share of common words have a key in common, one as the smaller and one as the larger; in one
    class each is both. counts: of the words' slots, as numbers or as bytes of the table.
    """
    doc = np.repeat(np.arange(len(sizes)), sizes)
    count = counts[(flat >> np.uint64(64 - DF_BITS)).astype(np.int64)]
    count = _ABOUT[count] if count.dtype == np.uint8 else count
    order = np.lexsort((flat, first_darts(flat, count), doc))
    word, count = flat[order], count[order]
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = sizes[doc]
    # With `place` darts before it that the other lacks, at most n - place words are common: s / (1 + s) * (n + m) or more.
    most = np.floor((n - place) * (1 + similarity) / similarity - n + 1e-6).astype(np.int64)
    least = np.ceil(similarity * n - 1e-6).astype(np.int64)
    kept = np.flatnonzero((most >= least) & (count > 1))  # a word of one record has no partner
    word, count, doc, n = word[kept], count[kept], doc[kept], n[kept]
    own, low, high = (np.searchsorted(_CLASSES, x, "right") - 1 for x in (n, np.maximum(least[kept], 1), most[kept]))
    low, high = (low, np.minimum(high, own)) if larger else (np.maximum(low, own), high)
    # The records of a hot word are spread by a salt on one side, and meet each salt's on the other.
    salts = count // SALT_ROWS + 1
    times = np.maximum(high - low + 1, 0) * (1 if larger else salts)
    at = np.repeat(np.arange(len(word)), times)
    index = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    salt = mix(ids.astype(np.int64).view(np.uint64))[doc[at]] % salts[at].astype(np.uint64) if larger else (index % salts[at]).astype(np.uint64)
    other = low[at] + (index if larger else index // salts[at])
    pair = np.minimum(own[at], other) * 4096 + np.maximum(own[at], other)
    key = mix(mix(word[at] + pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + salt)
    return doc[at], key


_KEYED = np.dtype([("key", "<u8"), ("id", "<i8"), ("map", "<u8"), ("n", "<u4")])  # n: twice the words, odd for the larger side


def _met(rows: np.ndarray, similarity: float) -> Iterator[np.ndarray]:
    """[pairs, 2] of ids: rows of both sides with equal keys whose bitmaps of words allow the similarity."""
    rows = rows[np.lexsort((rows["n"] & 1, rows["key"]))]
    starts = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    ends = np.append(starts[1:], len(rows))
    side = np.concatenate([[0], np.cumsum((rows["n"] & 1).astype(np.int64))])
    large = side[ends] - side[starts]
    small = ends - starts - large
    both = np.flatnonzero((large > 0) & (small > 0))
    starts, small, large = starts[both], small[both], large[both]
    # A row of the one side meets a run of rows of the other: (row, first of the run, length).
    row = np.repeat(starts, small) + np.arange(small.sum()) - np.repeat(np.cumsum(small) - small, small)
    first, length = np.repeat(starts + small, small), np.repeat(large, small)
    total = np.cumsum(length)
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK_PAIRS)))
        times = length[at:to]
        a = np.repeat(row[at:to], times)
        b = np.repeat(first[at:to], times) + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
        # Words in only one of the two are at most this share of all; each bit in only one map is such a word.
        differ = np.bitwise_count(rows["map"][a] ^ rows["map"][b])
        fine = (differ <= (1 - similarity) / (1 + similarity) * ((rows["n"][a] >> 1) + (rows["n"][b] >> 1)) + 1e-6) & (rows["id"][a] != rows["id"][b])
        x, y = rows["id"][a[fine]], rows["id"][b[fine]]
        yield np.stack([np.minimum(x, y), np.maximum(x, y)], 1)
        at = to


def _unique_pairs(found: list[np.ndarray]) -> np.ndarray:
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])] if len(pairs) else pairs


def candidates(sets: DataFrame, counts: StoredCounts, similarity: float, parts: int) -> DataFrame:
    """(id_a, id_b): pairs of sets that keep a dart in common and may be similar enough; none that is, is left out."""

    def make(batches: Iterator[pa.RecordBatch]):
        table = counts.load()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids, (n, flat) = part.column(0).to_numpy(), _unpacked(part.column(1))
                bits = np.zeros(len(n), np.uint64)
                np.bitwise_or.at(bits, np.repeat(np.arange(len(n)), n), np.uint64(1) << (mix(flat) & np.uint64(63)))
                for larger in (False, True):
                    doc, key = prefix_keys(ids, n, flat, table, similarity, larger)
                    rows = np.empty(len(doc), _KEYED)
                    rows["key"], rows["id"], rows["map"], rows["n"] = key, ids[doc], bits[doc], n[doc] * 2 + larger
                    yield (key % np.uint64(parts)).astype(np.int64), rows

    def take(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for pairs in chain(_met(rows, similarity), [None]):
            if pairs is not None:
                held.append(pairs)
                size += len(pairs)
            if size >= BLOCK_PAIRS or (pairs is None and size):
                out = _unique_pairs(held)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["id_a", "id_b"])
                held, size = [], 0

    return exchange(sets.select("id", "words"), make, take, parts, _KEYED, "id_a bigint, id_b bigint").distinct()


def near_sets(sets: DataFrame, similarity: float) -> DataFrame:
    """(id_a, id_b): sets (id, words) whose words in both are at least the given share of the words in either."""
    parts = max(8, sets.count() // PART_ROWS)
    met = materialize(candidates(sets, word_counts(sets, parts), similarity, parts), "candidates")
    used = materialize(met.select(F.col("id_a").alias("id")).union(met.select("id_b")).distinct(), "candidate-ids")
    words = with_ids(sets.select("id", "words"), used, "id")
    joined = met.join(words.withColumnsRenamed({"id": "id_a", "words": "words_a"}), "id_a").join(words.withColumnsRenamed({"id": "id_b", "words": "words_b"}), "id_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, flat = (np.concatenate(x) for x in zip(*(_unpacked(batch.column(f"words_{s}")) for s in "ab")))
            pair = np.repeat(np.tile(np.arange(batch.num_rows), 2), n)
            order = np.lexsort((flat, pair))
            flat, pair = flat[order], pair[order]
            both = np.bincount(pair[1:][(flat[1:] == flat[:-1]) & (pair[1:] == pair[:-1])], minlength=batch.num_rows)
            either = n[: batch.num_rows] + n[batch.num_rows :] - both
            keep = pa.array(both >= similarity * either - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(f"id_{s}").filter(keep) for s in "ab"], ["id_a", "id_b"])

    return joined.select("id_a", "id_b", "words_a", "words_b").mapInArrow(run, "id_a bigint, id_b bigint")


_HEAD = np.dtype([("key_a", "<i8"), ("key_b", "<i8"), ("id", "<i8"), ("n", "<i8"), ("size", "<i8")])


def classes(rows: DataFrame) -> DataFrame:
    """(id, key_a, key_b, n, words): each different set of caption_sets once, with its least id and its number of rows.

    Every task sends a set once for each of its batches, however many rows have it.
    """
    parts = max(8, rows.count() // PART_ROWS)

    def first_of(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each different key stands first in the order, and the head of each class."""
        order = np.lexsort((head["id"], head["key_b"], head["key_a"]))
        sorted_ = head[order]
        new = np.flatnonzero(np.concatenate([[True], (sorted_["key_a"][1:] != sorted_["key_a"][:-1]) | (sorted_["key_b"][1:] != sorted_["key_b"][:-1])]))
        out = sorted_[new].copy()
        out["n"] = np.add.reduceat(sorted_["n"], new)
        return order[new], out

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            head = np.empty(batch.num_rows, _HEAD)
            for name in ("id", "key_a", "key_b"):
                head[name] = batch.column(name).to_numpy()
            head["n"], head["size"] = 1, _unpacked(batch.column("words"))[0]
            at, head = first_of(head)
            words = batch.column("words").take(pa.array(at)).to_pylist()
            part = head["key_a"].view(np.uint64) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            used = np.flatnonzero(np.diff(edges))
            data = [np.int64(edges[p + 1] - edges[p]).tobytes() + head[order[edges[p] : edges[p + 1]]].tobytes() + b"".join(words[i] for i in order[edges[p] : edges[p + 1]]) for p in used]
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(data, pa.binary())], ["part", "data"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, words = [], []
        for batch in batches:
            for value in batch.column(1):
                raw = value.as_buffer().to_pybytes()
                m = int(np.frombuffer(raw, np.int64, 1)[0])
                head = np.frombuffer(raw, _HEAD, m, 8)
                ends = 8 + m * _HEAD.itemsize + np.cumsum(head["size"]) * WORD_BYTES
                heads.append(head)
                words += [raw[e - k * WORD_BYTES : e] for e, k in zip(ends.tolist(), head["size"].tolist())]
        if heads:
            at, head = first_of(np.concatenate(heads))
            for k in range(0, len(head), 20_000):
                part = head[k : k + 20_000]
                yield pa.RecordBatch.from_arrays([*[pa.array(part[c].copy()) for c in ("id", "key_a", "key_b", "n")], pa.array([words[i] for i in at[k : k + 20_000]], pa.binary())], ["id", "key_a", "key_b", "n", "words"])

    return rows.mapInArrow(send, "part int, data binary").repartitionById(parts, "part").mapInArrow(receive, "id bigint, key_a bigint, key_b bigint, n bigint, words binary")


def _sided(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id_a, id_b) of the members of linked classes: links (rep_a, rep_b), members (rep, id, n). A large class is spread
    by a salt, and its links meet every salt."""
    sizes = members.groupBy("rep").agg(F.first("n").alias("n"))
    salts = lambda n: F.ceil(F.col(n) / SALT_ROWS)
    placed = members.select("rep", F.pmod(F.xxhash64("id"), salts("n")).alias("salt"), "id")
    for side in "ab":
        links = links.join(sizes.select(F.col("rep").alias(f"rep_{side}"), F.explode(F.sequence(F.lit(0).cast("bigint"), salts("n") - 1)).alias("salt")), f"rep_{side}")
        links = links.join(placed.select(F.col("rep").alias(f"rep_{side}"), "salt", F.col("id").alias(f"of_{side}")), [f"rep_{side}", "salt"]).drop("salt")
    return links.select(F.least("of_a", "of_b").alias("id_a"), F.greatest("of_a", "of_b").alias("id_b"))


def near_captions(df: DataFrame, id_col: str = "pair_id", text_col: str = "caption", similarity: float = SIMILARITY, leave_out=None, tidy: bool = True) -> DataFrame:
    """(id_a, id_b): all pairs of rows, id_a < id_b, with near-identical captions of MIN_WORDS words or more.

    Rows with equal sets of words are compared once and all their pairs come out. leave_out: a function of a table of
    ids (id) that gives those (id) that don't count; it gets only rows that are in some pair. tidy: whether texts are
    still to be brought into one form. Null, empty and short captions have no pairs. Repeated ids: as one row each. An
    empty table gives no rows.
    """
    rows = materialize(caption_sets(df, id_col, text_col, tidy), "sets")
    sets = materialize(classes(rows), "classes")
    links = materialize(near_sets(sets, similarity), "links")
    linked = links.select(F.col("id_a").alias("id")).union(links.select("id_b")).distinct()
    used = sets.select("id", "key_a", "key_b", "n").join(linked.withColumn("_linked", F.lit(True)), "id", "left").where("_linked or n > 1").select(F.col("id").alias("rep"), "key_a", "key_b", "n")
    members = materialize(attach_group(rows.select("id", "key_a", "key_b"), used, ["key_a", "key_b"]).select("id", "rep", "n").distinct(), "members")
    if leave_out is not None:
        members = materialize(members.join(leave_out(members.select("id")).select("id").distinct(), "id", "left_anti"), "counted")
    sided = _sided(links.select(F.col("id_a").alias("rep_a"), F.col("id_b").alias("rep_b")), members)
    return pair_rows(members, ["rep"], "id").unionByName(sided).where("id_a < id_b")


def hash_masks(n: int, distance: int) -> list[int]:
    """Masks of parts of a 64-bit hash: two hashes within `distance` bits agree under one of them or more. The more
    hashes there are, the more bits a mask has."""
    equal = 2
    while equal < 5 and 2 ** (64 * equal // (distance + equal)) < n / 4:
        equal += 1
    edges = [64 * i // (distance + equal) for i in range(distance + equal + 1)]
    return [sum((1 << edges[i + 1]) - (1 << edges[i]) for i in picked) for picked in combinations(range(distance + equal), equal)]


def _within(key: np.ndarray, value: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of values with equal keys that differ in at most `distance` bits."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at, step = np.arange(len(key)), 1
    while True:
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count(value[at] ^ value[at + step]) <= distance]
        out_a.append(near)
        out_b.append(near + step)
        step += 1
    return order[np.concatenate(out_a)], order[np.concatenate(out_b)]


def _close(key: np.ndarray, value: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """As _within; keys of very many values are refined by a further part of the values, of which one must be equal."""
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    dense = np.flatnonzero(count[inverse] > DENSE)
    a, b = _within(*(x[count[inverse] <= DENSE] for x in (key, value)), distance)
    sparse = np.flatnonzero(count[inverse] <= DENSE)
    found = {(int(x), int(y)) for x, y in zip(sparse[a], sparse[b])} if len(dense) else None
    if found is None:
        return sparse[a], sparse[b]
    for i in range(distance + 1):
        low, high = 64 * i // (distance + 1), 64 * (i + 1) // (distance + 1)
        part = value[dense] & np.uint64((1 << high) - (1 << low))
        a, b = _within(mix(mix(key[dense]) ^ part), value[dense], distance)
        found |= {(int(min(x, y)), int(max(x, y))) for x, y in zip(dense[a], dense[b])}
    pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


_HASHED = np.dtype([("hash", "<u8"), ("tag", "u1")])


def near_hashes(df: DataFrame, id_col: str = "image_id", hash_col: str = "phash", distance: int = 5) -> DataFrame:
    """(id_a, id_b): all pairs of rows, id_a < id_b, whose 64-bit hashes (16 hex digits) differ in at most `distance` bits.

    None is lost (see hash_masks). Null and malformed hashes have no pairs. Rows with equal hashes are compared with
    others once. An empty table gives no rows.
    """
    if not 0 <= distance <= 8:
        raise ValueError("a distance of 0 to 8 bits")
    source = require(df, id_col, hash_col).select(F.col(id_col).alias("id"), F.lower(hash_col).alias("hex")).where("hex rlike '^[0-9a-f]{16}$'")
    number = (F.conv(F.substring("hex", 1, 8), 16, 10).cast("bigint"), F.conv(F.substring("hex", 9, 8), 16, 10).cast("bigint"))
    rows = materialize(source.select("id", F.shiftleft(number[0], 32).bitwiseOR(number[1]).alias("hash")).distinct(), "hashes")
    different = materialize(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), "different")
    size = different.count()
    masks = np.array(hash_masks(size, distance), np.uint64)
    tags = np.arange(len(masks))
    parts = max(8, size // 40_000)

    def make(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            value = batch.column(0).to_numpy().view(np.uint64)
            rows = np.empty((len(value), len(masks)), _HASHED)
            rows["hash"], rows["tag"] = value[:, None], tags
            key = mix((value[:, None] & masks) + mix(tags.astype(np.uint64) + np.uint64(1)))
            yield (key % np.uint64(parts)).astype(np.int64).ravel(), rows.ravel()

    def take(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        value, tag = rows["hash"], rows["tag"]
        a, b = _close(mix((value & masks[tag]) + mix(tag.astype(np.uint64) + np.uint64(1))), value, distance)
        differ = value[a] ^ value[b]
        first = np.ones(len(a), bool)  # a pair comes out under the first mask that it agrees under
        for k, mask in enumerate(masks):
            first &= (differ & mask != 0) | (tag[a] <= k)
        a, b = a[first & (tag[a] == tag[b])], b[first & (tag[a] == tag[b])]
        yield pa.RecordBatch.from_arrays([pa.array(value[x].view(np.int64)) for x in (a, b)], ["rep_a", "rep_b"])

    links = materialize(exchange(different.select("hash"), make, take, parts, _HASHED, "rep_a bigint, rep_b bigint"), "close")
    linked = links.select(F.col("rep_a").alias("hash")).union(links.select("rep_b")).distinct()
    used = different.join(linked.withColumn("_linked", F.lit(True)), "hash", "left").where("_linked or n > 1").select("hash", "n")
    members = materialize(attach_group(rows, used, ["hash"]).select("id", F.col("hash").alias("rep"), "n"), "pictures")
    return pair_rows(members, ["rep"], "id").unionByName(_sided(links, members))
