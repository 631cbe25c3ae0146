"""Problem 8: encoding texts with a public byte-level BPE vocabulary.

A short word is held as a contiguous row of parts with the rank of every adjacent pair. The row is scanned for its
least rank again and again, the boundary there is deleted, and the two neighbouring ranks are looked up anew. All new
words of a batch are merged side by side in numpy; words longer than `SHORT` bytes go through a heap instead, with the
same result. Ids of words are kept in a cache of bounded size.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import require

SHORT = 48  # bytes of a word that the rank rows take
CACHE_WORDS = 300_000  # words whose ids a Python worker remembers
CHUNK_CHARS = 1_500_000  # characters encoded at a time
NONE = np.int32(2**31 - 1)
DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits a text into words before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str = DEFAULT_VOCABULARY, folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("CAPSTRATA_TOKENIZERS", "/opt/tokenizers"), name)


class PairRanks:
    """Rank of two adjacent parts, in an open-addressing table keyed by the ids of both."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = get(token[:cut])
                if left is not None and (right := get(token[cut:])) is not None:
                    pairs[left << 16 | right] = rank
        self.bits = max(16, int(len(pairs) * 6).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        todo = np.fromiter(pairs.keys(), np.int64, len(pairs))
        ranks_of = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(todo)
        while len(todo):  # those that find a free slot take it, the rest move on by one
            free = np.flatnonzero(self.keys[slot] < 0)
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]] = todo[first]
            self.values[slot[first]] = ranks_of[first]
            left = np.ones(len(todo), bool)
            left[first] = False
            todo, ranks_of, slot = todo[left], ranks_of[left], (slot[left] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where they don't merge. Ids below 0 stand for no part."""
        key = (left.astype(np.int64) << 16) | right
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.values[slot], NONE)
        rest = np.flatnonzero((found != key) & (found >= 0) & (key >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[rest]]
            hit = found == key[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out


class RankedBpe:
    def __init__(self, path: str, pattern: str = PATTERN):
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.ranks = ranks
        self.pairs = PairRanks(ranks)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of at most SHORT bytes, each as the bytes of little-endian int32."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words])
        for low, high in ((1, 4), (5, 8), (9, 12), (13, 18), (19, SHORT)):
            members = np.flatnonzero((lengths >= low) & (lengths <= high))
            if not len(members):
                continue
            n = lengths[members]
            flat = np.frombuffer(b"".join([words[i] for i in members]), np.uint8)
            parts = np.full((len(members), high + 2), -1, np.int32)  # column 0 and the last stay empty
            row = np.repeat(np.arange(len(members)), n)
            parts[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n) + 1] = self.single[flat]
            rank = self.pairs(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(members), high + 1)
            kept = np.zeros((len(members), high + 2), np.int32)
            size = n.copy()
            live = np.arange(len(members))
            column = np.arange(high + 2)
            while True:
                at = rank.argmin(1)
                least = rank[np.arange(len(live)), at]
                done = least == NONE
                if done.any():
                    kept[live[done]] = parts[done]
                    going = ~done
                    live, parts, rank, at, least = live[going], parts[going], rank[going], at[going], least[going]
                if not len(live):
                    break
                here = np.arange(len(live))
                beyond = column[1:-1] > at[:, None]
                parts[:, 1:-1] = np.where(beyond, parts[:, 2:], parts[:, 1:-1])
                parts[here, at] = least
                rank[:, :-1] = np.where(beyond, rank[:, 1:], rank[:, :-1])
                fresh = self.pairs(np.concatenate([parts[here, at - 1], least]), np.concatenate([least, parts[here, at + 1]]))
                rank[here, at - 1], rank[here, at] = fresh[: len(here)], fresh[len(here) :]
                size[live] -= 1
            ids = kept[:, 1:]
            joined = ids[np.arange(ids.shape[1]) < size[:, None]].tobytes()
            end = np.cumsum(size) * 4
            for i, a, b in zip(members.tolist(), (end - size * 4).tolist(), end.tolist()):
                out[i] = joined[a:b]
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same merges through a heap of (rank, place): a long word costs n log n."""
        ids = [int(self.single[b]) for b in word]
        text = [bytes([b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get = self.ranks.get
        heap = [(r, i) for i in range(len(ids) - 1) if (r := get(text[i] + text[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if text[i] is None or j >= len(ids) or get(text[i] + text[j]) != rank:
                continue
            text[i], ids[i], text[j], after[i] = text[i] + text[j], rank, None, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
                if (r := get(text[i] + text[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get(text[before[i]] + text[i])) is not None:
                heapq.heappush(heap, (r, before[i]))
        return np.array([k for k, t in zip(ids, text) if t is not None], np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as the bytes of int32; b"" for an empty text and for None."""
        split = [self.split(t) if t else () for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache = self.cache
        new = [w for w in set().union(*split) if w not in cache]
        raw = [w.encode("utf-8", "replace") for w in new]
        short = [i for i, w in enumerate(raw) if len(w) <= SHORT]
        cache.update(zip([new[i] for i in short], self.merge_short([raw[i] for i in short])))
        for w, r in zip(new, raw):
            if len(r) > SHORT:
                cache[w] = self.merge_long(r)
        out = [b"".join(map(cache.__getitem__, words)) for words in split]
        for w, r in zip(new, raw):
            if len(r) > SHORT:
                del cache[w]  # long ones hardly come again
        return out


_loaded: dict[str, RankedBpe] = {}


def encoder(path: str) -> RankedBpe:
    if path not in _loaded:
        _loaded[path] = RankedBpe(path)
    return _loaded[path]


def _chunks(texts: pa.Array) -> Iterator[list[str | None]]:
    chunk: list[str | None] = []
    size = 0
    for text in texts.to_pylist():
        chunk.append(text)
        size += len(text or "")
        if size > CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id_col, ids array<int>) of every row, without special tokens.

    Strings that look like special tokens are ordinary text. Null, empty: an empty list. Repeated rows and ids: a row
    each. An empty table: no rows. Other columns are ignored.
    """
    path = vocabulary or vocabulary_path()
    source = require(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            start = 0
            for chunk in _chunks(batch.column(1)):
                ids = bpe.encode(chunk)
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ids)), pa.ListArray.from_arrays(pa.array(offsets), values)], [id_col, "ids"])
                start += len(ids)

    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, ids array<int>")


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id_col, n_tokens bigint): the lengths of `encode_texts`, without carrying the ids."""
    path = vocabulary or vocabulary_path()
    source = require(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            sizes = [len(x) // 4 for chunk in _chunks(batch.column(1)) for x in bpe.encode(chunk)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], [id_col, "n_tokens"])

    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, n_tokens bigint")
