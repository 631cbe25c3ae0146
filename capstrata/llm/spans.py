"""Problem 10: long exact spans shared between documents, by content-defined chunking.

A gear hash rolls over the characters (each hash depends on the last CONTEXT of them). A chunk ends where the hash is
the least of some WINDOW hashes in a row, so that cuts depend on the text nearby alone and an insertion moves only the
cuts next to it. Two neighbouring cuts are at most WINDOW characters apart; therefore two equal runs of
CONTEXT - 1 + 2 * WINDOW characters or more (159, so 160 by default) hold at least one whole equal chunk together with its
context. Chunks are grouped by a 128-bit digest of context and chunk; pairs of documents in a group are joined chunk by
chunk, and runs that the chunks alone don't prove long enough are compared in the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, require

CONTEXT = 64
BLOCK = 64  # documents of a hot digest that are paired in one row of blocks
BATCH_CHARS = 2_000_000


def window_for(min_chars: int, context: int = CONTEXT) -> int:
    """The largest window that still guarantees a whole chunk inside each run of min_chars."""
    if min_chars < context + 3:
        raise ValueError(f"spans need at least {context + 3} characters")
    return (min_chars - context + 1) // 2


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix: the gear of a character, by rule instead of by table."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_gears = _mix(np.arange(0x110000, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % (1 << 64)
    return out[:n]


def _sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op over x[i : i + width], shorter at the end; by doubling."""
    out, done = x.copy(), 1
    while done < width:
        step = min(done, width - done)
        out[:-step] = op(out[:-step], out[step:].copy())
        done += step
    return out


def cut_points(codes: np.ndarray, starts: np.ndarray, window: int, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all places and the places that are cuts, of texts laid end to end from `starts`."""
    h = _gears[codes]
    gear, reach = h, 1
    while reach < context:  # h over the last `reach` characters becomes h over twice as many
        older = np.zeros_like(h)
        older[reach:] = h[:-reach] << np.uint64(reach)
        h, reach = h + older, reach * 2
    worst = np.uint64(2**64 - 1)
    order = h ^ (h >> np.uint64(29))
    head = (starts[:, None] + np.arange(context - 1)).ravel()
    order[head[head < len(order)]] = worst  # these hashes would reach into the text before
    least = _sliding(np.minimum, order, window)
    best = _sliding(np.maximum, least[::-1], window)[::-1]
    return gear, np.flatnonzero((best == order) & (order != worst))


def chunk_rows(ids: np.ndarray, texts: list[str], window: int, context: int = CONTEXT, repeated: bool = False):
    """(id, digest_hi, digest_lo, start, end) of each chunk; start and end count the characters of its own text.

    A chunk's digest also covers the `context` - 1 characters before it. Equal chunks of one text come once, or,
    if repeated, each.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    gear, cuts = cut_points(codes, starts, window, context)
    doc = np.searchsorted(starts, cuts, "right") - 1
    same = doc[1:] == doc[:-1]
    begin, end, doc = cuts[:-1][same] + 1, cuts[1:][same] + 1, doc[1:][same]
    low = begin - context
    power = _powers(int(_BASE), len(codes) + 1)
    inverse = _powers(pow(int(_BASE), -1, 1 << 64), len(codes) + 1)
    summed = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(gear * power[:-1], out=summed[1:])
    hi = (summed[end] - summed[low]) * inverse[low]
    turned = _mix(gear)
    np.cumsum(turned * power[:-1], out=summed[1:])
    lo = (summed[end] - summed[low]) * inverse[low]
    size = (end - low).astype(np.uint64)
    hi, lo = _mix(hi ^ size), _mix(lo + size)
    _, first = np.unique(np.stack([doc.astype(np.uint64), hi, lo]).T.copy().view("u8,u8,u8").ravel(), return_index=True) if len(doc) else (None, np.zeros(0, int))
    first = np.arange(len(doc)) if repeated else first
    first.sort()
    doc, begin, end = doc[first], begin[first] - starts[doc[first]], end[first] - starts[doc[first]]
    return ids[doc], hi[first].view(np.int64), lo[first].view(np.int64), begin.astype(np.int32), end.astype(np.int32)


def document_chunks(df: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text", repeated: bool = False) -> DataFrame:
    """(id, hi, lo, start, end): the chunks of all texts of at least min_chars characters."""
    source = require(df, id_col, text_col).where(F.length(text_col) >= min_chars)
    window = window_for(min_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= BATCH_CHARS):
                    size += len(texts[to])
                    to += 1
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in chunk_rows(ids[at:to], texts[at:to], window, repeated=repeated)], ["id", "hi", "lo", "start", "end"])
                at = to

    return source.mapInArrow(run, "id bigint, hi bigint, lo bigint, start int, end int")


def shared_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks whose digest occurs in two documents or more, numbered in place. One shuffle, by digest."""
    by = Window.partitionBy("hi", "lo").orderBy("id", "start")  # a stream over sorted rows: no group is held in memory
    numbered = chunks.withColumn("place", F.row_number().over(by)).withColumn("_next", F.lead("id").over(by))
    return numbered.where("place > 1 or _next is not null").drop("_next")


def _met(shared: DataFrame, *fields: str) -> DataFrame:
    """(x, y): structs of the fields of all rows with equal digests, x before y in the order of ids. A digest of very many
    documents is cut into blocks, and a block meets each other one under the number of that one: no task holds the group."""
    members = shared.withColumn("block", F.floor((F.col("place") - 1) / BLOCK))
    blocks = members.groupBy("hi", "lo", "block").agg(F.collect_list(F.struct(*fields)).alias("rows"))
    before = blocks.select("hi", "lo", "block", F.col("rows").alias("xs"))
    after = blocks.select("hi", "lo", F.col("rows").alias("ys"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("block"))).alias("block"))
    return before.join(after, ["hi", "lo", "block"]).select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y"))


def shared_spans(df: DataFrame, min_chars: int = 160, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_a, id_b): the pairs of rows, id_a < id_b, whose texts have a run of min_chars characters in common.

    Null, empty and shorter texts have none. A repetition inside one text is no case; rows with the same id count as
    one text. An empty table gives no rows.
    """
    shared = materialize(shared_chunks(document_chunks(df, min_chars, id_col, text_col)), "chunks")
    paired = (
        _met(shared, "id", "start", "end")
        .where("x.id < y.id")
        .select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"), (F.col("x.start") - F.col("y.start")).alias("shift"), F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    )
    runs = (
        paired.groupBy("id_a", "id_b", "shift")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.col("end") - F.col("start")).alias("matched"))
        .withColumn("proven", (F.col("matched") == F.col("end") - F.col("start")) & (F.col("matched") + CONTEXT - 1 >= min_chars))
    )
    runs = materialize(runs.groupBy("id_a", "id_b").agg(F.max("proven").alias("proven")), "runs")
    proven = runs.where("proven").select("id_a", "id_b")
    texts = require(df, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    open_pairs = runs.where("not proven").select("id_a", "id_b")
    compared = (
        open_pairs.join(texts.withColumnsRenamed({"id": "id_a", "text": "text_a"}), "id_a").join(texts.withColumnsRenamed({"id": "id_b", "text": "text_b"}), "id_b").mapInArrow(_compare(min_chars), "id_a bigint, id_b bigint")
    )
    return proven.unionByName(compared).distinct()


def longest_common_run(a: str, b: str, at_least: int) -> bool:
    """Whether the texts have a run of at_least characters in common: every run holds a multiple of a stride."""
    stride = max(1, at_least // 2)
    size = at_least - stride + 1  # any run of at_least holds a piece of this size at a multiple of stride
    if len(a) > len(b):
        a, b = b, a
    pieces: dict[str, list[int]] = {}
    for i in range(0, len(a) - size + 1, stride):
        pieces.setdefault(a[i : i + size], []).append(i)
    for piece, places in pieces.items():
        j = b.find(piece)
        while j >= 0:
            for i in places:
                left = 0
                while left < i and left < j and left < stride and a[i - left - 1] == b[j - left - 1]:
                    left += 1
                right = size
                while i + right < len(a) and j + right < len(b) and left + right < at_least and a[i + right] == b[j + right]:
                    right += 1
                if left + right >= at_least:
                    return True
            j = b.find(piece, j + 1)
    return False


def _compare(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            a, b = (batch.column(names.index(f"text_{s}")).to_pylist() for s in "ab")
            keep = pa.array([longest_common_run(x, y, min_chars) for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(names.index(f"id_{s}")).filter(keep) for s in "ab"], ["id_a", "id_b"])

    return run


def _extend(min_chars: int):
    """(id, start, end) of both texts: each chunk match drawn out to its maximal common run, if that is long enough."""

    def common(a: np.ndarray, b: np.ndarray) -> int:
        """How many characters are equal from the start of both."""
        n, at, step = min(len(a), len(b)), 0, 64
        while at < n:
            differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
            if len(differ):
                return at + int(differ[0])
            at, step = at + step, step * 4
        return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[int, int, int]] = set()
            columns = [batch.column(c).to_pylist() for c in ("id_a", "id_b", "matches", "text_a", "text_b")]
            for id_a, id_b, matches, text_a, text_b in zip(*columns):
                a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (text_a, text_b))
                done: dict[int, int] = {}  # by shift, how far its last run goes
                for m in sorted(matches, key=lambda m: m["start_a"]):
                    i, j = m["start_a"], m["start_b"]
                    if i < done.get(i - j, 0):
                        continue
                    left, right = common(a[:i][::-1], b[:j][::-1]), common(a[i:], b[j:])
                    done[i - j] = i + right
                    if left + right >= min_chars:
                        out |= {(id_a, i - left, i + right), (id_b, j - left, j + right)}
            ids, starts, ends = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["id", "start", "end"])

    return run


def shared_passages(df: DataFrame, min_chars: int = 160, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end): each maximal run of min_chars characters or more that a text has in common with another text.

    All occurrences come out, those repeated inside one text too; runs with different texts may overlap. Rows with the
    same id count as one text.
    """
    shared = materialize(shared_chunks(document_chunks(df, min_chars, id_col, text_col, repeated=True)), "occurrences")
    matches = (
        _met(shared, "id", "start")
        .where("x.id < y.id")
        .groupBy(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
        .agg(F.collect_set(F.struct(F.col("x.start").alias("start_a"), F.col("y.start").alias("start_b"))).alias("matches"))
    )
    texts = require(df, id_col, text_col).toDF("id", "text")
    both = matches.join(texts.withColumnsRenamed({"id": "id_a", "text": "text_a"}), "id_a").join(texts.withColumnsRenamed({"id": "id_b", "text": "text_b"}), "id_b")
    return both.mapInArrow(_extend(min_chars), "id bigint, start int, end int").distinct()


def shared_share(df: DataFrame, min_chars: int = 160, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, shared_chars, share): how much of each text lies in runs of min_chars or more that stand in other texts too.

    Every row of the table comes out; null and empty texts have 0 characters and a share of 0.0. Each character counts
    once, and a passage repeated inside one text counts each time.
    """
    spans = shared_passages(df, min_chars, id_col, text_col)
    order = Window.partitionBy("id").orderBy("start", "end")
    spans = spans.withColumn("before", F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sums = spans.groupBy("id").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).alias("shared_chars"))
    rows = require(df, id_col, text_col).select(F.col(id_col).alias("id"), F.coalesce(F.length(text_col), F.lit(0)).cast("bigint").alias("n_chars"))
    out = rows.join(sums, "id", "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)).cast("bigint"))
    return out.select(F.col("id").alias(id_col), "n_chars", "shared_chars", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0).alias("share"))
