"""Problem 2: values cut by a field limit or in transfer, and how often each source cuts.

A backward character n-gram model: for the last k characters before a place (words that are rare in the corpus stand as
one mark each), how often does a text end there, and how often does it go on? Further tables do the same for the letters
before the end of a rare word, for the first letters of a word, and for the last words of a text of few words. All come
from all different values of all sources; ends at a limit or with a mark of omission don't count as ends. The sums lie in
the shared folder and workers read them there; the driver never holds them. A value's log-odds of going on against
ending, for its final context, is compared with a threshold for each language, validated on trusted complete values
(labels and sentences), and moved for each source by how seldom its values end without a closing sign. A length at the
limit of the source, in characters or bytes, and a mark of omission add to the log-odds. Where the words of a value stand
in no usual order, its end says nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import encoding
from .canon import repair
from .chars import mix
from .common import materialize, require, with_ids

ORDERS = (1, 3, 6, 10, 16, 28, 44)  # characters of the masked contexts
WORD_ORDERS = (2, 3, 4, 6)  # letters of the contexts inside rare words
DF_BITS, BITS = 20, 19
COMMON = 2e-4  # a word in a larger share of rows is common
TAIL = 110
PART = 2048  # counts of a table that travel together
SHORT_WORDS, SHORT_ORDERS = 9, (1, 2)  # words from the start of a text without other signs, and how many of the last ones
TABLES = len(ORDERS) + len(WORD_ORDERS) + len(SHORT_ORDERS) + 1  # the last one is of the first letters of words
THRESHOLD, AT_LIMIT, MARKED = 3.8, 8.0, 6.0  # log-odds; the most that a length at the limit adds; what a mark adds
CLOSING = 4.0  # what a closing sign takes off: a cut falls behind one by chance only
SUPPORT, SHORT_SUPPORT = 10.0, 3.0  # how many times the shorter context counts in the longer one
LONG = 16  # from this order on one ending isn't counted: it may be a changed copy of the same cut value
STRANGE = 2  # so many places within a value where nobody else goes on like that: the order of its words is unusual
STRANGE_ORDER = 3  # which of ORDERS tells it
UNSPACED = 0x2E80  # from this character on no spaces stand between words
SMALL = 100_000  # rows of a table by source that is broadcast; a larger one is joined in a shuffle
MARK = re.compile(r"(?:…|\.\.\.|\[(?:more|…|\.\.\.)\]|\((?:more|…)\)|(?:read|see) more)\s*$", re.I)

#: Fixed value: what closes a sentence or an addition. How often a source's values end otherwise is counted with it.
CLOSING_SIGNS = ".!?\u3002\uff01\uff1f\uff0e)]}>\"\u201d\u00bb"
CHUNK = 16_000  # rows looked at together

_bmp = list(map(chr, range(0x10000)))
_lower = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in _bmp], np.uint64)
_wordy = np.array([c.isalnum() and not "⺀" <= c <= "퟿" for c in _bmp])
_upper = np.array([c.isupper() for c in _bmp])
_digit = np.array([c.isdigit() for c in _bmp])
_POWER = np.uint64(0x100000001B3)


_known_powers: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _known_powers or len(_known_powers[0]) < n:
        size = max(n, 1 << 21)
        _known_powers[:] = [np.cumprod(np.full(size, b, np.uint64)) for b in (int(_POWER), pow(int(_POWER), -1, 1 << 64))]
    return _known_powers[0][:n], _known_powers[1][:n]


def unmarked(text: str) -> str:
    """The text without a mark of omission at its end."""
    if text[-1:] not in "….])eE" or (found := MARK.search(text, max(0, len(text) - 16))) is None:
        return text
    return text[: found.start()].rstrip()


def closed(texts: list[str]) -> np.ndarray:
    return np.array([t[-1:] != "" and t[-1] in CLOSING_SIGNS for t in texts], bool)


def formed(text: str) -> tuple[str, bool]:
    """The value in one form, decoded as UTF-8 where it plainly was taken for another charset; and whether it was not."""
    if text.isascii():
        return text.rstrip(), True
    clean = bool(encoding.clean([text]))
    if not clean:
        found = encoding.candidates(text, True)
        text = found[-1][0] if found else text
    return repair(text).rstrip(), clean


def normal(text: str) -> str:
    return formed(text)[0]


class Masked:
    """Texts laid end to end, with their words and, once the common words are known, masked."""

    def __init__(self, texts: list[str]):
        joined = np.frombuffer(("\x01" + "\x01".join(texts) + "\x01").encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(joined < 0x10000, joined, 0xFFFD).astype(np.int64)
        self.lower, self.codes = _lower[codes], codes
        word = _wordy[codes]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        self.begin, self.end = edge[::2], edge[1::2]
        # A polynomial over the letters, by cumulative sums with the inverse power taken off.
        n = len(codes) + 1
        power, inverse = _powers(n)
        total = np.zeros(n, np.uint64)
        np.cumsum(mix(self.lower) * power[:-1], out=total[1:])
        self.total = total
        self.hash = mix((total[self.end] - total[self.begin]) * inverse[self.begin])
        self.text_end = np.flatnonzero(joined == 1)[1:]  # the place after each text
        self.owner = np.searchsorted(self.text_end, self.begin)

    def mask(self, common: np.ndarray) -> None:
        slot = (self.hash >> np.uint64(64 - DF_BITS)).astype(np.int64)
        self.rare = ~common[slot]
        rare, begin, end = self.rare, self.begin, self.end
        first = self.codes[begin]
        sign = np.where(_digit[first], ord("0"), np.where(_upper[first], ord("N"), ord("n"))).astype(np.uint64)
        masked = self.lower.copy()
        masked[begin[rare]] = sign[rare]
        inside = np.bincount(begin[rare] + 1, minlength=len(masked) + 1) - np.bincount(end[rare], minlength=len(masked) + 1)
        kept = np.cumsum(inside[:-1]) == 0
        self.masked = masked[kept]
        self.place = np.cumsum(kept) - 1  # of each character in the masked row

    def final(self) -> np.ndarray:
        """Of each word, whether its text ends with it."""
        return self.codes[self.end] == 1

    def prefixes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots of all first letters of the given words, whether they are the whole word, and which word it is."""
        begin, size = self.begin[words], self.end[words] - self.begin[words]
        of = np.repeat(np.arange(len(words)), size)
        count = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + 1
        first = begin[of]
        power, inverse = _powers(len(self.total))
        h = mix((self.total[first + count] - self.total[first]) * inverse[first])
        return (h >> np.uint64(64 - BITS)).astype(np.int64), count == size[of], of

    def small(self) -> np.ndarray:
        """Of each word, whether it begins with a small letter, or one without case."""
        first = self.codes[self.begin]
        return ~_upper[first] & ~_digit[first]

    def short_contexts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The words that stand among the first SHORT_WORDS of a text with nothing but spaces before, and for each of
        SHORT_ORDERS the slots of their number with the last words up to them; rare words count as one."""
        start = np.concatenate([[0], self.text_end[:-1]])
        number = np.arange(len(self.begin)) - np.searchsorted(self.begin, start)[self.owner] + 1
        signs = np.cumsum(~_wordy[self.codes] & (self.codes != 32) & (self.codes != 1))
        words = np.flatnonzero((number <= SHORT_WORDS) & (signs[self.end - 1] == signs[start[self.owner]]))
        seen = np.where(self.rare, np.uint64(7), self.hash)
        out, h = [], mix(number[words].astype(np.uint64) + np.uint64(11))
        for back in range(max(SHORT_ORDERS)):
            h = mix(h * np.uint64(31) + np.where(number[words] > back, seen[np.maximum(words - back, 0)], np.uint64(3)))
            if back + 1 in SHORT_ORDERS:
                out.append((h >> np.uint64(64 - BITS)).astype(np.int64))
        return words, out

    def contexts(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Slots of the contexts before each place where a word or a sign ends, whether a text ends there, the place, and
        how many characters of the text stand up to it."""
        m = self.masked
        after = np.concatenate([m[1:], [np.uint64(1)]])
        letters = _wordy[np.minimum(m, 0xFFFF).astype(np.int64)]
        inner = letters & np.concatenate([letters[1:], [False]])
        at = np.flatnonzero(~inner & (m != 1) & ((m != 32) | (after == 1)))
        n = len(m) + 1
        power, inverse = _powers(n)
        total = np.zeros(n, np.uint64)
        np.cumsum(mix(m + np.uint64(7)) * power[:-1], out=total[1:])
        out = []
        heads = np.flatnonzero(m == 1)
        head = heads[np.searchsorted(heads, at, "right") - 1]  # a context reaches back to the text's start at most
        for k in ORDERS:
            low = np.maximum(at + 1 - k, head)
            out.append((mix((total[at + 1] - total[low]) * inverse[low] + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64))
        return out, after[at] == 1, at, at - head

    def word_contexts(self, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Slots of the letters before `end`, inside words that begin at `begin`."""
        power, inverse = _powers(len(self.total))
        upto, out = self.total[end], []
        for k in WORD_ORDERS:
            low = np.maximum(end - k, begin)  # a shorter context reaches back to the word's start
            out.append((mix((upto - self.total[low]) * inverse[low] + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64))
        return out


def without_strangers(table: np.ndarray) -> None:
    """Takes off a table (all, ending) what a slot holds of contexts that share it by chance.

    Where more contexts were seen than there are slots, that is what the middle slot holds, and twice its spread; a
    context nobody else has then counts as unseen, and the shorter one speaks for it. Sparse tables stay as they are.
    """
    usual = np.median(table[0])
    if usual:
        most = usual + 2 * np.sqrt(usual)
        low = table[0] <= most
        ending = most * table[1][low].sum() / table[0][low].sum()
        table[0] = np.rint(np.maximum(table[0] - most, 0))
        table[1] = np.rint(np.clip(table[1] - ending, 0, table[0]))


class EndModel:
    """Counts (all, ending) of contexts, and the backed-off chance that a text or a word ends after them."""

    def __init__(self, common: np.ndarray, counts: np.ndarray, thresholds: dict[str, float] | None = None):
        self.common, self.thresholds = common, thresholds or {}
        tables = counts.reshape(TABLES, 2, -1).copy()
        for table in tables:
            without_strangers(table)
        self.texts, self.words, self.short, self.first = np.split(tables, np.cumsum([len(ORDERS), len(WORD_ORDERS), len(SHORT_ORDERS)]))

    @staticmethod
    def _chance(tables: np.ndarray, slots: list[np.ndarray], floor: float, support: float, own: list[tuple] | None = None, less: tuple[int, ...] = ()) -> np.ndarray:
        """own: for each table what the value itself added to both counts, which must not speak for it. less: what is
        taken off the endings of each table besides. The tables go from short contexts to long ones, and none is seen
        more often than a shorter one of it: what a slot has beyond that is of others."""
        p, most, most_ended = np.full(len(slots[0]), floor), np.inf, np.inf
        for table, slot, (seen, ended), off in zip(tables, slots, own or [(0, 0)] * len(slots), less or [0] * len(slots)):
            most = np.minimum(np.maximum(table[0][slot] - seen, 0), most)
            most_ended = np.minimum(np.maximum(table[1][slot] - ended - off, 0), np.minimum(most_ended, most))
            p = (most_ended + support * p) / (most + support)
        return np.maximum(p, 1e-9)

    def log_odds(self, values: list[str], seen: np.ndarray | None = None, ended: np.ndarray | None = None, share: np.ndarray | None = None) -> np.ndarray:
        """For each value, the log-odds of its final context that the text was to go on.

        seen, ended: whether the value is among the counted texts, and whether its end is among the counted ends. share:
        how many times as often as elsewhere the value's source has ends of its kind.
        """
        tails, whole = [], np.zeros(len(values), bool)
        for i, v in enumerate(values):
            cut = v[-TAIL:]
            whole[i] = len(cut) == len(v)
            tails.append(cut if whole[i] or " " not in cut[:60] else cut[cut.index(" ") :])
        row = Masked(tails)
        row.mask(self.common)
        slots, ends, at, before = row.contexts()
        of = np.searchsorted(row.place[row.text_end], at)
        final = np.flatnonzero(ends)
        out = np.zeros(len(values))
        owner = of[final]
        none = np.zeros(len(values), bool)
        seen, ended = (none if x is None else x for x in (seen, ended))
        # A context that reaches beyond the tail of a longer value isn't the one that was counted.
        own = [((r & seen[owner]).astype(np.int32), (r & ended[owner]).astype(np.int32)) for r in (whole[owner] | (k <= before[final]) for k in ORDERS)]
        p = np.ones(len(values))
        p[owner] = self._chance(self.texts, [s[final] for s in slots], 0.003, SUPPORT, own, tuple(int(k >= LONG) for k in ORDERS))
        words, short = row.short_contexts()
        last = np.flatnonzero(row.final()[words] & whole[row.owner[words]])
        who = row.owner[words[last]]
        own = [(seen[who].astype(np.int32), ended[who].astype(np.int32))] * len(short)
        if len(last):
            p[who] = np.maximum(p[who], self._chance(self.short, [s[last] for s in short], 0.003, SHORT_SUPPORT, own))
        p = np.minimum(p * (1.0 if share is None else share), 1 - 1e-6)
        out[owner] = (np.log1p(-p) - np.log(p))[owner]
        # The last word, where it is a rare one: does it end there, or in the middle? No last word is counted.
        last = np.flatnonzero(row.rare & row.final())
        small = row.small()[last]
        names, who = last[~small], row.owner[last]
        if len(names):
            w = self._chance(self.words, row.word_contexts(row.begin[names], row.end[names]), 0.2, SUPPORT)
            letters = ~_digit[row.codes[row.end[names] - 1]]
            out[who[~small]] += np.where(letters, np.maximum(np.log(0.35) - np.log(w), 0.0), 0.0)
        if small.any():
            slot = (row.hash[last[small]] >> np.uint64(64 - BITS)).astype(np.int64)
            begun, done = (self.first[0][k][slot].astype(float) for k in (0, 1))
            out[who[small]] = np.maximum(out[who[small]], np.log((np.maximum(begun - done, 0) + 0.5) / (done + 0.5)))
        # Places within the value that no other value has: where there are several, its words were moved about.
        usual = np.minimum.reduce([table[0][s] for table, s in zip(self.texts[: STRANGE_ORDER + 1], slots)]) - seen[np.minimum(of, len(values) - 1)] > 1
        # Without spaces the names aren't masked, and any name is such a place.
        spaced = row.masked[at] < UNSPACED
        strange = ~usual & ~ends & spaced & (whole[np.minimum(of, len(values) - 1)] | (before >= ORDERS[STRANGE_ORDER]))
        moved = np.bincount(of[strange], minlength=len(values))[: len(values)] >= STRANGE
        return np.where(moved, np.minimum(out, 0.0), out)


class StoredModel:
    """An EndModel by the files of its counts, which each worker reads once."""

    _last: tuple[tuple, EndModel] | None = None

    def __init__(self, common: np.ndarray, files: list[str]):
        self.common, self.files, self.thresholds = common, tuple(sorted(files)), {}

    def load(self) -> EndModel:
        if StoredModel._last is None or StoredModel._last[0] != self.files:
            counts = np.zeros(TABLES * 2 << BITS, np.int32)
            for name in self.files:
                fs, path = pafs.FileSystem.from_uri(name)
                with fs.open_input_file(path) as f:
                    for batch in pq.ParquetFile(f).iter_batches(256):
                        _unpack(batch, counts)
            StoredModel._last = self.files, EndModel(self.common, counts)
        model = StoredModel._last[1]
        model.thresholds = self.thresholds
        return model


def _unpack(batch: pa.RecordBatch, out: np.ndarray) -> None:
    for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
        found = np.frombuffer(data.as_buffer(), np.int32)
        out[part * PART : part * PART + len(found)] = found


def _sum_tables(texts: DataFrame, shape: int, fill: Callable[[list, np.ndarray], None]) -> DataFrame:
    """(part, data): a table of `shape` counts summed over all partitions, PART int32 in a row; parts of zeros are left out.

    Each partition sends its own sums once, in the narrowest type that holds a part.
    """
    n_parts = -(-shape // PART)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(n_parts * PART, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                fill([c.to_pylist() for c in batch.slice(at, CHUNK).columns], table[:shape])
        rows = table.reshape(-1, PART)
        most = rows.max(1)
        used = np.flatnonzero(most)
        for at in range(0, len(used), 256):
            some = used[at : at + 256]
            data = [rows[i].astype(np.min_scalar_type(most[i])).tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(data, pa.binary())], ["part", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(raw := data.as_buffer(), f"u{len(raw) // PART}")
                if part in sums:
                    sums[part] += found
                else:
                    sums[part] = found.astype(np.int64)
        for part, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())], ["part", "data"])

    kind = "part int, data binary"
    return texts.mapInArrow(count, kind).repartition("part").mapInArrow(add, kind)


def _open(text: str):
    """Whether a text ends without a closing sign."""
    last = F.right(F.rtrim(F.col(text)), F.lit(1))
    return ~last.isin(*CLOSING_SIGNS)


def sizes(df: DataFrame, source_col: str = "source", text_col: str = "caption") -> DataFrame:
    """(source, characters, bytes, n, all): how many texts of a source have each size, n of them without a closing sign."""
    texts = require(df, source_col, text_col).toDF("source", "text").where(F.length("text") > 0)
    return texts.groupBy("source", F.length("text").alias("characters"), F.octet_length("text").alias("bytes")).agg(F.count_if(_open("text")).alias("n"), F.count(F.lit(1)).alias("all"))


def limits(counted: DataFrame, unit: str = "characters") -> DataFrame:
    """(source, limit, excess): of the rows of `sizes`, lengths at which many texts of a source end without a closing
    sign, and beyond which hardly any goes. unit: characters or bytes; a limit of bytes also cuts some bytes short of
    it, before a longer character.
    """
    if unit not in ("characters", "bytes"):
        raise ValueError(f"unknown unit: {unit}")
    spare = 0 if unit == "characters" else 3
    by, source = Window.partitionBy("source").orderBy("size"), Window.partitionBy("source")
    near = F.coalesce(F.sum("n").over(by.rangeBetween(-10 - spare, -1 - spare)), F.lit(0)) / 10
    beyond = F.coalesce(F.sum("all").over(by.rangeBetween(1, Window.unboundedFollowing)), F.lit(0))
    full = counted.groupBy("source", F.col(unit).alias("size")).agg(F.sum("n").alias("n"), F.sum("all").alias("all"))
    full = full.withColumn("near", near).withColumn("at", (F.col("n") >= 8) & (F.col("n") > 3 * (F.col("near") + 1)) & (beyond <= 0.002 * F.sum("all").over(source)))
    # The shorter values of a limit of bytes are measured by what stands before that limit.
    full = full.withColumn("near", F.first(F.when(F.col("at"), F.col("near")), ignorenulls=True).over(by.rangeBetween(0, spare)))
    return full.where("near is not null and n > 0").select("source", F.col("size").alias("limit"), (F.col("n") / (F.col("near") + 0.5)).alias("excess")).where("excess > 1")


def by_source(df: DataFrame, source_col: str = "source", text_col: str = "caption") -> DataFrame:
    """(source, characters, bytes, share): the limits of a source as maps of length to excess, and how many times as
    often as in all sources its values end without a closing sign."""
    counted = materialize(sizes(df, source_col, text_col), "sizes")
    free = counted.groupBy("source").agg(F.sum("all").alias("all"), F.sum("n").alias("open"))
    total = free.agg(F.sum("all").alias("total"), F.sum("open").alias("total_open"))
    mean = F.col("total_open") / F.col("total")
    share = (F.col("open") + 5 * mean) / (F.col("all") + 5) / F.greatest(mean, F.lit(1e-6))
    out = free.crossJoin(F.broadcast(total)).select("source", share.alias("share"))  # total is one row
    for unit in ("characters", "bytes"):
        out = out.join(limits(counted, unit).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("limit", "excess"))).alias(unit)), "source", "left")
    return materialize(out, "sources")


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows (source, text, ...) with excess, null away from limits, and share."""
    sources = F.broadcast(sources) if sources.count() <= SMALL else sources
    at = lambda unit, size: F.try_element_at(unit, size)
    joined = rows.join(sources, "source", "left")
    excess = F.greatest(at(F.col("characters"), F.length("text")), at(F.col("bytes"), F.octet_length("text")))
    return joined.withColumn("excess", F.when(_open("text"), excess)).drop("characters", "bytes")


def prepared(df: DataFrame, id_col: str = "pair_id", text_col: str = "caption", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(id, text, source, lang, excess, share, clean, raw): every row with its text in one form; null texts are empty. clean:
    whether nothing in it was decoded wrongly; raw: a clean text as it was, where it was in another form."""
    base = require(df, id_col, text_col, source_col, lang_col).toDF("id", "text", "source", "lang")
    rows = with_source(base, by_source(base, "source", "text")).select("id", "text", "source", "lang", "excess", F.coalesce("share", F.lit(1.0)).alias("share"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            texts, clean = zip(*(formed(t) if t else ("", False) for t in raw)) if raw else ((), ())
            other = [a if c and a != b else None for a, b, c in zip(raw, texts, clean)]
            added = [pa.array(clean, pa.bool_()), pa.array(other, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *batch.columns[2:], *added], [*batch.schema.names, "clean", "raw"])

    return materialize(rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", clean boolean, raw string"), "values")


def train(values: DataFrame, refs: DataFrame) -> StoredModel:
    """The model of all different values (see `prepared`); refs: (lang, ref_text), trusted complete values for the thresholds."""
    # A value that was delivered twice is one: a cut one must not speak for itself.
    texts = values.where("text <> ''").groupBy("text", "source").agg(F.max(F.col("excess").isNotNull()).alias("at_limit")).select("text", "at_limit")

    def count_words(columns: list, table: np.ndarray) -> None:
        row = Masked([t for t in columns[0] if t])
        slot = (row.hash[~row.final()] >> np.uint64(64 - DF_BITS)).astype(np.int64)  # the last word may itself be cut
        table[:-1] += np.bincount(slot, minlength=len(table) - 1).astype(np.int32)
        table[-1] += len(columns[0])

    counted = np.zeros((1 << DF_BITS) + PART, np.int32)
    for batch in _sum_tables(values.select("text"), (1 << DF_BITS) + 1, count_words).toArrow().to_batches():
        _unpack(batch, counted)
    common = counted[: 1 << DF_BITS] > max(2.0, COMMON * int(counted[1 << DF_BITS]))
    shared = values.sparkSession.sparkContext.broadcast(common)

    def count_contexts(columns: list, flat: np.ndarray) -> None:
        row = Masked(columns[0])
        row.mask(shared.value)
        cut = np.array([c or len(unmarked(t)) < len(t) for t, c in zip(*columns)], bool)
        tables = iter(flat.reshape(TABLES, 2, -1))

        def add(slots: np.ndarray, ends: np.ndarray, times: np.ndarray | None = None) -> None:
            table = next(tables)
            table[0] += np.bincount(slots, times, table.shape[1]).astype(np.int32)
            np.add.at(table[1], slots[ends], np.int32(1) if times is None else times[ends].astype(np.int32))  # few

        slots, ends, at, _ = row.contexts()
        owner = np.searchsorted(row.place[row.text_end], at)
        ends &= ~cut[np.minimum(owner, len(cut) - 1)]
        for s in slots:
            add(s, ends)
        inner = np.flatnonzero(row.rare & ~row.final())  # the last word may itself be cut
        size = row.end[inner] - row.begin[inner]
        begin = np.repeat(row.begin[inner], size)
        end = begin + np.arange(len(begin)) - np.repeat(np.cumsum(size) - size, size) + 1
        whole = end == np.repeat(row.end[inner], size)
        for s in row.word_contexts(begin, end):
            add(s, whole)
        words, short = row.short_contexts()
        ends = row.final()[words] & ~cut[row.owner[words]]
        for s in short:
            add(s, ends)
        small = np.flatnonzero(row.small() & ~row.final())
        _, one, times = np.unique(row.hash[small], return_index=True, return_counts=True)
        s, whole, of = row.prefixes(small[one])
        add(s, whole, times[of])

    counts = materialize(_sum_tables(texts, TABLES * 2 << BITS, count_contexts), "ends")
    model = StoredModel(common, counts.inputFiles())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = model.load()
        for batch in batches:
            langs, values = (c.to_pylist() for c in batch.columns)
            values = [normal(t) for t in values]
            odds = end.log_odds(values) - CLOSING * closed(values) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(odds, pa.float64())], ["lang", "odds"])

    by: dict[str, list[float]] = {}
    for r in refs.mapInArrow(judge, "lang string, odds double").collect():
        by.setdefault(r.lang, []).append(r.odds)
    model.thresholds = {lang: max(THRESHOLD, sorted(v)[-1 - len(v) // 30] + 0.1) for lang, v in by.items()}
    return model


def truncated(df: DataFrame, refs: DataFrame, id_col: str = "pair_id", text_col: str = "caption", source_col: str = "source", lang_col: str = "lang", model: StoredModel | None = None, rows: DataFrame | None = None, residue=None, values: DataFrame | None = None) -> DataFrame:
    """(id, source, cut, log_odds): for each row whether its text was cut.

    Null and blank texts are not cut; a null source has no limit. Repeated rows: a row each. An empty table gives no
    rows. refs: a bounded table of trusted values. rows: a written table of the ids to judge, where not all are.
    residue: a model of texts that aren't descriptions; rows that it finds are not cut. values: what `prepared` gave.
    """
    from .language import label_language

    values = prepared(df, id_col, text_col, source_col, lang_col) if values is None else values
    if model is None:
        model = train(values, require(refs, "lang", "ref_text").where("ref_text is not null"))
    shared = df.sparkSession.sparkContext.broadcast((model, residue))
    judged = values.select("id", "text", "source", "lang", "excess", "share")
    judged = judged if rows is None else with_ids(judged, rows, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored, other = shared.value
        end = stored.load()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                texts = part.column("text").to_pylist()
                bare = [unmarked(t) for t in texts]
                marked = np.array([len(b) < len(t) for b, t in zip(bare, texts)], bool)
                seen = np.array([t != "" for t in texts], bool)
                free = part.column("excess").is_null().to_numpy(zero_copy_only=False)
                shut = closed(bare)
                share = np.where(shut, 1.0, np.clip(part.column("share").to_numpy(), 0.02, 2.5))
                odds = end.log_odds(bare, seen, seen & free & ~marked, share) + MARKED * marked - CLOSING * shut
                cut = []
                for whole, t, value, lang, excess in zip(texts, bare, odds.tolist(), part.column("lang").to_pylist(), part.column("excess").to_pylist()):
                    need = end.thresholds.get(label_language(lang) or "", THRESHOLD)
                    if excess is not None:
                        need -= min(AT_LIMIT, float(np.log(excess)) + 1)
                    cut.append(any(map(str.isalnum, t)) and value > need and not (other is not None and other.found(whole)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("source"), pa.array(cut, pa.bool_()), pa.array(odds, pa.float64())], ["id", "source", "cut", "log_odds"])

    return judged.mapInArrow(run, "id bigint, source string, cut boolean, log_odds double")
