"""Problem 7: the language of every text and of each part of a mixed one, with a confidence.

Every language has a probability for each piece of a fixed public vocabulary. A forward algorithm sums over all ways to
cut a word into pieces, so that a word's likelihood doesn't hang on one segmentation. The probabilities are learned by
expectation-maximization from trusted texts and then from a bounded sample of labelled rows that agree with them. A
text's words are decoded with a cost for every change of language, which finds the parts of a mixed text.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import mix
from .common import require, sample_share

LANGUAGES = ("en", "zh", "de", "fr", "es", "ru", "pt")
#: Other names of the languages in labels.
NAMES = {"eng": "en", "english": "en", "zho": "zh", "chi": "zh", "chinese": "zh", "deu": "de", "ger": "de", "german": "de", "fra": "fr", "fre": "fr", "french": "fr", "spa": "es", "spanish": "es", "rus": "ru", "russian": "ru", "por": "pt", "portuguese": "pt"}
SAMPLE_ROWS = 20_000  # bound of the labelled rows that the model is fitted on, a share by a hash of their id
FIT_WORD = 64  # longer words are left out when the model is fitted; they are scored as any other
SMALL, LIFT = 1e-120, 1e120  # probabilities below the one are lifted by the other while a long word is summed
CHANGE = 9.0  # cost of a change of language between two words
PART_WORDS, PART_HAN, PART_GAIN = 4, 8, 12.0  # the least that makes a part a part: words, or Chinese characters, and log-odds
LABEL_BONUS = 4.0  # log-odds that the delivered label counts
FLOOR = 2e-7  # probability of a piece that a language never showed
UNKNOWN = 1e-7  # and of a character that is no piece, outside the language's script; inside it, SCRIPT
SCRIPT = 2e-4
CHUNK = 4000

_words = re.compile(r"[一-鿿㐀-䶿]+|[^\W\d_一-鿿㐀-䶿]+")
_quoted = re.compile("[“\"«„「][^“”\"«»„「」]{1,40}[”\"»“」]")


def label_language(label: str | None) -> str | None:
    """The language that a label names in any spelling; None where it names none."""
    if not label:
        return None
    base = label.strip().lower().replace("_", "-").split("-")[0]
    return base if base in LANGUAGES else NAMES.get(base)


def vocabulary(path: str) -> list[str]:
    """The pieces that words in lower case can be made of: of letters without capitals, and the mark of a word's start."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())}
    return sorted(p for p in pieces if p and p == p.lower() and (p.lstrip("▁") or p == "▁") and all(c == "▁" or c.isalpha() for c in p))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
TABLE_BITS, NONE, SHARED = 20, -1, -2


def _script(codes: np.ndarray) -> np.ndarray:
    """0 Latin, 1 Cyrillic, 2 Han, 3 other."""
    return np.select([(codes < 0x250) | (codes == 0x2581), (codes >= 0x400) & (codes < 0x530), (codes >= 0x3400) & (codes < 0xA000)], [0, 1, 2], 3)


_script_of = {"zh": 2, "ru": 1}


class PieceModel:
    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        codes, starts, sizes = self._lay(pieces)
        keys = self._hashes(codes, starts, sizes)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order
        self.longest = int(sizes.max(initial=1))
        # The piece of each slot of a table by the upper bits of the key; SHARED where several pieces have the slot.
        slots = (self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.slots = np.full(1 << TABLE_BITS, NONE, np.int32)
        self.slots[slots] = np.arange(len(slots))
        again = slots[1:][slots[1:] == slots[:-1]]
        self.slots[again] = SHARED
        self.p = np.full((len(pieces), len(LANGUAGES)), 1.0 / len(pieces))
        self.other = np.array([[SCRIPT if _script_of.get(lang, 0) == s else UNKNOWN for lang in LANGUAGES] for s in range(4)])
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(LANGUAGES)))

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "table": np.zeros((0, len(LANGUAGES)))}

    @staticmethod
    def _lay(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        return codes, np.cumsum(sizes) - sizes, sizes

    @staticmethod
    def _hashes(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(starts), np.uint64)
        for k in range(int(sizes.max(initial=0))):
            on = sizes > k
            h[on] = h[on] * _BASE + mix(codes[starts[on] + k].astype(np.uint64))
        return mix(h)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        out = np.full(len(keys), -1, np.int64)
        some = np.flatnonzero(at >= 0)
        some = some[self.keys[at[some]] == keys[some]]
        out[some] = self.ids[at[some]]
        shared = np.flatnonzero(at == SHARED)
        if len(shared):
            place = np.minimum(np.searchsorted(self.keys, keys[shared]), len(self.keys) - 1)
            out[shared] = np.where(self.keys[place] == keys[shared], self.ids[place], -1)
        return out

    def lattice(self, words: list[str]):
        """(starts, sizes, places, per piece length the ids of the pieces that end at each place, scripts)."""
        codes, starts, sizes = self._lay(words)
        mixed = mix(codes.astype(np.uint64))
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        h, found = np.zeros(len(codes), np.uint64), []
        power = np.uint64(1)
        for k in range(1, min(self.longest, int(sizes.max(initial=0))) + 1):
            # The hash of the last k characters: one more character in front of the last k - 1.
            h = h.copy()
            h[k - 1 :] += mixed[: len(mixed) - k + 1] * power
            power = np.multiply(power, _BASE, dtype=np.uint64) if k == 1 else (np.array([power]) * _BASE)[0]
            ok = np.flatnonzero(place >= k - 1)
            ids = np.full(len(codes), -1, np.int64)
            ids[ok] = self._find(mix(h[ok]))
            found.append(ids)
        return starts, sizes, place, found, _script(codes)

    def forward(self, lattice, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """alpha at the end of each word, or, if whole, before all words (1) and at the end of each place; and by how many
        LIFTs the last ones of each word are too large.

        Rows are laid out step by step, longer words first, so that a step reads and writes rows that lie together.
        """
        starts, sizes, place, found, script = lattice
        longest, order = int(sizes.max(initial=0)), np.argsort(-sizes, kind="stable")
        first = starts[order]
        width = np.searchsorted(-sizes[order], -np.arange(longest))  # words that reach each step
        offset = np.concatenate([[0, len(sizes)], len(sizes) + np.cumsum(width)])  # of the rows before any step, and behind each one
        rank = np.empty(len(sizes), np.int64)
        rank[order] = np.arange(len(sizes))
        of = np.repeat(rank, sizes)  # of each place
        # All pieces found, in the order of where they end in their word.
        ends = [np.flatnonzero(ids >= 0) for ids in found]
        end, size = np.concatenate([np.zeros(0, np.int64), *ends]), np.repeat(np.arange(1, len(found) + 1), [len(e) for e in ends])
        piece = np.concatenate([np.zeros(0, np.int64), *(ids[e] for ids, e in zip(found, ends))])
        by = np.lexsort((of[end], place[end]))
        end, size, piece = end[by], size[by], piece[by]
        step, word = place[end], of[end]
        before = offset[np.maximum(step + 1 - size, 0)] + word
        steps = np.searchsorted(step, np.arange(longest + 1))
        alpha = np.ones((offset[-1], len(LANGUAGES)))
        lifts = np.zeros((len(sizes), len(LANGUAGES)))
        for i in range(longest):
            n, out = width[i], alpha[offset[i + 1] : offset[i + 1] + width[i]]
            np.multiply(alpha[offset[i] : offset[i] + n], self.other[script[first[:n] + i]], out=out)
            few = slice(steps[i], steps[i + 1])
            w = word[few]
            if len(w):
                new = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                out[w[new]] += np.add.reduceat(alpha[before[few]] * self.p[piece[few]], new)
            if i >= 8 and out.min() < SMALL:
                low, lang = np.nonzero(out < SMALL)
                for back in range(min(i + 1, len(found))):
                    alpha[offset[i + 1 - back] + low, lang] *= LIFT
                lifts[order[low], lang] += 1
        if whole:
            return np.concatenate([np.ones((1, len(LANGUAGES))), alpha[offset[place + 1] + of]]), lifts
        return alpha[offset[sizes] + rank], lifts

    def fit(self, counts: dict[str, np.ndarray], rounds: int) -> None:
        """Expectation-maximization over words with their counts in each language."""
        words = [w for w in counts if len(w) <= FIT_WORD]
        for _ in range(rounds):
            sums = np.zeros(self.p.shape)
            for first in range(0, len(words), 20_000):
                part = words[first : first + 20_000]
                lattice = self.lattice(part)
                starts, sizes, place, found, script = lattice
                other = self.other[script]
                alpha, lifts = self.forward(lattice, True)
                share = np.where(lifts > 0, 0.0, np.array([counts[w] for w in part]) / np.maximum(alpha[starts + sizes], 1e-300))
                word = np.repeat(np.arange(len(part)), sizes)
                beta = np.ones((len(place), len(LANGUAGES)))  # what follows a place; nothing follows the last one
                for back in range(1, int(sizes.max(initial=0))):
                    at = (starts + sizes - 1 - back)[sizes > back]
                    total = other[at + 1] * beta[at + 1]
                    for k in range(1, min(back, len(found)) + 1):
                        ids = found[k - 1][at + k]
                        hit = np.flatnonzero(ids >= 0)
                        total[hit] += self.p[ids[hit]] * beta[at[hit] + k]
                    beta[at] = total
                for k, ids in enumerate(found, 1):
                    hit = np.flatnonzero(ids >= 0)
                    before = np.where((place[hit] >= k)[:, None], alpha[np.maximum(hit + 1 - k, 0)], 1.0)
                    use = before * self.p[ids[hit]] * beta[hit] * share[word[hit]]
                    for lang in range(len(LANGUAGES)):
                        sums[:, lang] += np.bincount(ids[hit], use[:, lang], len(sums))
            self.p = np.maximum(sums / np.maximum(sums.sum(0), 1e-9), FLOOR)

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods [len(words), languages]; words met before come from a cache of bounded size."""
        if len(self.known) > 150_000:
            self.known, self.table = {}, np.zeros((0, len(LANGUAGES)))
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            alpha, lifts = self.forward(self.lattice(new))
            z = np.log(np.maximum(alpha, 1e-300)) - lifts * np.log(LIFT)
            self.known.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, z])
        return self.table[[self.known[w] for w in words]] if words else np.zeros((0, len(LANGUAGES)))


def split_words(text: str) -> list[str]:
    """Words in lower case with the mark of a word's start, Chinese runs without; quoted inscriptions don't count."""
    kept = _quoted.sub(" ", text)
    found = _words.findall(kept.lower()) or _words.findall(text.lower())
    return [w if "\u3400" <= w[0] <= "\u9fff" else "\u2581" + w for w in found]


def decode(model: PieceModel, lists: list[list[str]]) -> list[list[tuple[int, int, int, float]]]:
    """For each list of words its parts (language, first word, end, confidence); a text of one language has one part."""
    n = np.array([len(x) for x in lists], np.int64)
    if not len(n) or not n.max():
        return [[] for _ in lists]
    scores = model.rows_of([w for x in lists for w in x])
    starts = np.cumsum(n) - n
    longest, rows = int(n.max()), len(lists)
    best = np.zeros((rows, len(LANGUAGES)))
    came = np.zeros((longest, rows), np.int8)  # the language before, where a change paid
    stay = np.ones((longest, rows, len(LANGUAGES)), bool)
    order = np.argsort(-n, kind="stable")
    for t in range(longest):
        on = order[: np.searchsorted(-n[order], -t)]
        top = best[on].argmax(1)
        change = best[on, top] - CHANGE
        keep = best[on] >= change[:, None]
        stay[t, on], came[t, on] = keep, top
        best[on] = np.where(keep, best[on], change[:, None]) + scores[starts[on] + t]
    final = best.argmax(1)
    lang, changed = final.copy(), np.zeros(rows, bool)
    for t in range(longest - 1, 0, -1):
        on = order[: np.searchsorted(-n[order], -t)]
        moved = on[~stay[t, on, lang[on]]]
        changed[moved], lang[moved] = True, came[t, moved]
    filled = np.flatnonzero(n)
    sums = np.zeros((rows, len(LANGUAGES)))
    sums[filled] = np.add.reduceat(scores, starts[filled])
    mains = sums.argmax(1)
    sure = np.exp(np.clip((sums - sums.max(1, keepdims=True)) / 2.0, -60, 0))
    sure = sure.max(1) / sure.sum(1)
    out = []
    for i, size, main, confidence, mixed in zip(range(rows), n.tolist(), mains.tolist(), sure.tolist(), changed.tolist()):
        if not size:
            out.append([])
        elif not mixed:
            out.append([(main, 0, size, confidence)])
        else:
            own = scores[starts[i] : starts[i] + size]
            lang, end, parts = int(final[i]), size, []
            for t in range(int(n[i]) - 1, -1, -1):
                if t and not stay[t, i, lang]:
                    parts.append((lang, t, end))
                    lang, end = int(came[t, i]), t
            parts.append((lang, 0, end))
            parts.reverse()
            main = max(parts, key=lambda q: sum(min(len(w), 8) for w in lists[i][q[1] : q[2]]))[0]
            kept = []
            for p in parts:
                words = lists[i][p[1] : p[2]]
                size = sum(len(w) for w in words) if p[0] == 1 else 0
                gain = (own[p[1] : p[2], p[0]] - own[p[1] : p[2], main]).sum()
                if p[0] == main or ((size >= PART_HAN if p[0] == 1 else len(words) >= PART_WORDS) and gain >= PART_GAIN):
                    kept.append(p)
            parts = []
            for p in kept:  # neighbours of one language are one part again
                if parts and parts[-1][0] == p[0]:
                    parts[-1] = (p[0], parts[-1][1], p[2])
                else:
                    parts.append(p)
            done = []
            for p in parts:
                part = own[p[1] : p[2]].sum(0)
                part = np.exp(np.clip((part - part.max()) / 2.0, -60, 0))
                done.append((*p, float(part[p[0]] / part.sum())))
            out.append(done)
    return out


def learn(refs: list[tuple[str, str]], labelled: list[tuple[str | None, str]], path: str) -> PieceModel:
    """The model from trusted texts, then also from labelled ones whose label it shares."""
    model = PieceModel(vocabulary(path))

    def counted(rows: list[tuple[str, str]]) -> dict[str, np.ndarray]:
        counts: dict[str, np.ndarray] = {}
        for lang, text in rows:
            for w, k in Counter(split_words(text)).items():
                counts.setdefault(w, np.zeros(len(LANGUAGES)))[LANGUAGES.index(lang)] += k
        return counts

    trusted = [(lang, t) for lang, t in refs if lang in LANGUAGES and t]
    model.fit(counted(trusted), 4)
    rows = [(label_language(label), t) for label, t in labelled]
    found = [q for at in range(0, len(rows), CHUNK) for q in decode(model, [split_words(t) for _, t in rows[at : at + CHUNK]])]
    agreed = [(lang, t) for (lang, t), parts in zip(rows, found) if lang and len(parts) == 1 and LANGUAGES[parts[0][0]] == lang and parts[0][3] > 0.9]
    if agreed:
        model.fit(counted(trusted + agreed), 3)
    model.known, model.table = {}, np.zeros((0, len(LANGUAGES)))
    return model


def vocabulary_path(name: str = "piece_bpe_32k.model", folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("CAPSTRATA_TOKENIZERS", "/opt/tokenizers"), name)


def train(df: DataFrame, refs: DataFrame, id_col: str = "pair_id", text_col: str = "caption", lang_col: str = "lang", path: str | None = None) -> PieceModel:
    """The model of the trusted texts (refs: lang, ref_text) and about SAMPLE_ROWS labelled rows at any size."""
    trusted = [(r[0], r[1]) for r in require(refs, "lang", "ref_text").where("ref_text is not null").collect()]  # a bounded table
    picked = sample_share(require(df, id_col, text_col, lang_col), id_col, SAMPLE_ROWS).where(F.length(text_col) > 0)
    return learn(trusted, [(r[0], r[1]) for r in picked.select(lang_col, text_col).collect()], path or vocabulary_path())


def languages(df: DataFrame, refs: DataFrame, id_col: str = "pair_id", text_col: str = "caption", lang_col: str = "lang", model: PieceModel | None = None, residue=None) -> DataFrame:
    """(id, part, lang, confidence, text, label, wrong): a row for each part of each text, in the text's order.

    label is the language that the row's label names, or null; wrong is true on all parts of a text that is mixed, or
    whose label is missing or names another language. text holds the part's words. Null and blank texts, and texts
    without letters, have no rows. Repeated rows: rows each. An empty table gives no rows. residue: a model of texts
    that aren't descriptions; rows that it finds are never wrong.
    """
    from .truncation import normal

    source = require(df, id_col, text_col, lang_col)
    shared = df.sparkSession.sparkContext.broadcast((model or train(df, refs, id_col, text_col, lang_col), residue))
    names = ["id", "part", "lang", "confidence", "text", "label", "wrong"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, other = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(at, CHUNK)
                lists = [split_words(normal(t)) if t else [] for t in piece.column(1).to_pylist()]
                columns: list[list] = [[] for _ in names]
                for row, text, words, label, parts in zip(*(piece.column(c).to_pylist() for c in (0, 1)), lists, piece.column(2).to_pylist(), decode(judge, lists)):
                    named = label_language(label)
                    if len(parts) == 1 and named and LANGUAGES[parts[0][0]] != named:
                        scores = judge.rows_of(words).sum(0)
                        if scores[parts[0][0]] - scores[LANGUAGES.index(named)] < LABEL_BONUS:  # too little to go against the label
                            parts = [(LANGUAGES.index(named), *parts[0][1:])]
                    wrong = len({p[0] for p in parts}) > 1 or any(LANGUAGES[p[0]] != named for p in parts)
                    wrong = wrong and not (other is not None and other.found(text))
                    for k, (lang, first, end, sure) in enumerate(parts):
                        for column, value in zip(columns, (row, k, LANGUAGES[lang], sure, " ".join(w.lstrip("\u2581") for w in words[first:end]), named, wrong)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return source.mapInArrow(run, "id bigint, part int, lang string, confidence double, text string, label string, wrong boolean")
