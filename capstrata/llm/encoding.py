"""Problem 5: texts decoded with the wrong character encoding, found and restored.

A character n-gram model is trained on the clean rows. For every text, each chain "encode with the wrong charset, decode
with the right one" is tried on the whole text and on every stretch it fits; the likeliest result is accepted when its
log-likelihood, less the chain's cost, exceeds the text's own by a margin. The margin is the smallest one that lets at
most ALARMS of the trusted texts through while those garbled on purpose are found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chars import CharModel, count_ngrams
from .common import require

ALARMS = 0.0
DEPTH = 3  # a text may have passed through several wrong decodings
#: Charsets that UTF-8 is taken for, and other pairs of (taken for, really).
FOR_UTF8 = ["cp1252", "cp1251", "cp437", "mac_roman", "cp850", "koi8_r", "cp866"]
OTHERS = [
    ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1252", "cp866"), ("cp1252", "gb18030"), ("cp1252", "big5"),
    ("cp1251", "koi8_r"), ("cp1251", "cp866"), ("cp1251", "gb18030"), ("cp1251", "big5"), ("cp1251", "cp1252"),
    ("koi8_r", "cp1251"), ("cp866", "cp1251"), ("cp437", "cp866"), ("cp437", "gb18030"), ("cp437", "cp1251"), ("mac_roman", "cp1251"), ("mac_roman", "gb18030"),
    ("gb18030", "cp1251"), ("gb18030", "koi8_r"),
]
UTF8_COST, OTHER_COST = 3.0, 8.0
FAIR = -5.0  # mean log-probability of a character from which a text of Han characters is not tried under other charsets
SURE = re.compile("[\ufffd\x80-\x84\x86-\x9f]")


def _byte_map(charset: str) -> dict[str, int]:
    """Characters of a single-byte charset; the control character of a byte's number stands for the byte as well."""
    out: dict[str, int] = {}
    for b in range(256):
        try:
            out.setdefault(bytes([b]).decode(charset), b)
        except UnicodeDecodeError:
            pass
    for b in range(0x80, 0xA0):
        out.setdefault(chr(b), b)
    return out


#: Blocks that a character of a caption is expected in.
_plausible = re.compile("[\x85\u00a0-\u058f\u1e00-\u206f\u20a0-\u20bf\u2100-\u22ff\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001faff]")


class Utf8As:
    """UTF-8 taken for a single-byte charset: valid byte sequences are found by one pattern and decoded one by one."""

    cost = UTF8_COST

    def __init__(self, wrong: str):
        self.table = _byte_map(wrong)
        self.letters = wrong in ("koi8_r", "cp866")  # letters in a row are common words there, not UTF-8
        span = lambda low, high: "[" + "".join(re.escape(c) for c, b in self.table.items() if low <= b <= high) + "]"
        more = span(0x80, 0xBF)
        self.space = next((c for c, b in self.table.items() if b == 0xC3), None)
        lost = f"|{re.escape(self.space)} (?= |$|[a-z])" if self.space else ""  # a no-break space that became a plain one
        self.pattern = re.compile(f"{span(0xC2, 0xDF)}{more}|{span(0xE0, 0xEF)}{more}{{2}}|{span(0xF0, 0xF4)}{more}{{3}}{lost}")

    def _one(self, found: re.Match) -> str:
        old = found.group()
        if old[-1] == " ":
            return "\u00e0"
        try:
            new = bytes([self.table[c] for c in old]).decode("utf-8")
        except UnicodeDecodeError:
            return old
        usual = old.isalpha() and "\u0400" <= old[0] <= "\u045f" and (self.letters or new >= "\u0800")
        return new if _plausible.match(new) and not usual else old

    def apply(self, text: str) -> str | None:
        return new if self.pattern.search(text) and (new := self.pattern.sub(self._one, text)) != text else None


class OtherAs:
    """A charset taken for another one: stretches of high characters are encoded and decoded as a whole."""

    cost = OTHER_COST

    def __init__(self, wrong: str, right: str):
        self.right = right
        if wrong == "gb18030":
            self.encode = lambda s: s.encode("gb18030")
            self.pattern = re.compile("[\u3000-\u33ff\u4e00-\u9fa5\ufe30-\uffe5]{2,}")
        else:
            table = _byte_map(wrong)
            self.encode = lambda s: bytes([table[c] for c in s])
            high = "".join(re.escape(c) for c, b in table.items() if b >= 0x80)
            inner = " ,.:;()-" if right not in ("gb18030", "big5") else "\\x40-\\x7e"
            least = 1 if (wrong, right) == ("cp1251", "cp1252") else 3
            self.pattern = re.compile(f"[{high}]{{{least}}}(?:[{inner}]?[{high}]+)*")

    def _one(self, found: re.Match) -> str:
        old = found.group()
        try:
            new = self.encode(old).decode(self.right)
        except (UnicodeError, KeyError):
            return old
        return old if any(c < " " or "\x7f" <= c < "\xa0" for c in new) else new

    apply = Utf8As.apply


class Utf8AsGb:
    """UTF-8 taken for GB 18030: two characters hold the bytes of three in twos; a last odd byte may be lost."""

    cost = UTF8_COST
    pattern = re.compile("[\u00a4-\u00f7\u2010-\u2642\u3000-\u33ff\u4e00-\u9fa5\ue000-\ue864\ufe30-\uffe5\u20ac]{2,}\\??")

    @staticmethod
    def _one(found: re.Match) -> str:
        old = found.group()
        try:
            raw = old.rstrip("?").encode("gb18030")
            new = raw.decode("utf-8", "ignore")
        except UnicodeError:
            return old
        return new if len(new.encode()) >= 0.85 * len(raw) and len(new) >= 2 else old

    apply = Utf8As.apply


_steps: list = []


def steps() -> tuple[list, list]:
    """The ways back for UTF-8, and for other charsets."""
    if not _steps:
        _steps.append([*map(Utf8As, FOR_UTF8), Utf8AsGb()])
        _steps.append([OtherAs(*pair) for pair in OTHERS])
    return _steps[0], _steps[1]


_latin_only = re.compile("^(?:[\x00-\x7f]|[\u00c0-\u017f](?![\u0080-\u00bf\u00c0-\u00ff\u0152-\u2122]{2})|[\u2013-\u2026\u00ab\u00bb\u00a1\u00bf])*$")


def candidates(text: str, fair: bool = False) -> list[tuple[str, float]]:
    """The text under each chain that changes it, with the chain's cost. fair: only ways back to UTF-8 are tried."""
    back, other = steps()
    out: dict[str, float] = {}
    level = {text: 0.0}
    for _ in range(DEPTH):
        level = {new: cost + step.cost for form, cost in level.items() for step in back if (new := step.apply(form)) is not None and new != text and new not in out}
        out |= level
        if not level:
            break
    if not fair and not _latin_only.match(text):
        for step in other:
            if (new := step.apply(text)) is not None and new not in out:
                out[new] = step.cost
    return list(out.items())


def clean(texts: list[str]) -> list[str]:
    """Those in which no way back to UTF-8 finds anything to decode, and that lost no character."""
    back = steps()[0]
    return [t for t in texts if t.isascii() or not _beyond.search(t) or not _maybe.search(t) or not (SURE.search(t) or any(s.apply(t) is not None for s in back))]


#: No way back to UTF-8 changes a text without any of these: the letters left out stand for no byte inside a sequence,
#: but in cp866, where a row of letters is taken for words.
_beyond = re.compile("[^\x00-\x7f\u0410-\u044f]")
_han = re.compile("[\u4e00-\u9fff]")
#: No chain changes a text without any of these: two high characters in a row, a lost no-break space, a Cyrillic letter.
_maybe = re.compile("[^\x00-\x7f]{2}|\u00c3 |[\u0400-\u045f]|\ufffd|[\x80-\x9f]")


def restore(model: CharModel, texts: list[str | None], margin: float) -> tuple[list[bool], list[str | None]]:
    """For each text: whether it is garbled, and the text restored as far as it can be."""
    garbled, best = [False] * len(texts), list(texts)
    rows = [i for i, t in enumerate(texts) if t and not t.isascii() and _maybe.search(t)]
    if not rows:
        return garbled, best
    own = model.score([texts[i] for i in rows])
    owner, forms, costs = [], [], []
    for k, i in enumerate(rows):
        text = texts[i]
        for form, cost in candidates(text, bool(_han.search(text)) and own[k] / len(text) > FAIR):
            owner.append(k)
            forms.append(form)
            costs.append(cost)
    gain = model.score(forms) - np.array(costs) - own[owner] if forms else np.zeros(0)
    top = np.full(len(rows), margin)
    for k, form, value in zip(owner, forms, gain.tolist()):
        if value > top[k]:
            top[k], garbled[rows[k]], best[rows[k]] = value, True, form
    for i in rows:
        if SURE.search(texts[i]):
            garbled[i] = True
    return garbled, best


def validated_margin(model: CharModel, trusted: list[str]) -> float:
    """The least margin, 0 or more, at which no more than a share of ALARMS of the trusted texts is taken for garbled."""
    own = model.score(trusted)
    gains = [max((float(v) - c - float(own[i]) for v, (_, c) in zip(model.score([f for f, _ in found]), found)), default=-np.inf) for i, t in enumerate(trusted) if not t.isascii() and (found := candidates(t))]
    allowed = int(ALARMS * len(trusted))
    worst = sorted(gains, reverse=True)
    return max(0.0, worst[allowed] if allowed < len(worst) else 0.0)


def train(texts: DataFrame, refs: DataFrame, ref_col: str = "ref_text", sure: bool = False) -> tuple[CharModel, float]:
    """The model of all clean rows of a one-column table, and the margin that the trusted texts (a bounded table) allow.
    sure: all rows are known to be clean."""
    trusted = [r[0] for r in require(refs, ref_col).where(f"`{ref_col}` is not null").collect()]
    model = CharModel(count_ngrams(texts, list if sure else clean))
    return model, validated_margin(model, trusted)


def repaired(df: DataFrame, refs: DataFrame, id_col: str = "pair_id", text_col: str = "caption", ref_col: str = "ref_text", trained: tuple[CharModel, float] | None = None) -> DataFrame:
    """(id, garbled, restored): garbled is true where a text, throughout or in a stretch, was decoded wrongly.

    restored is the likeliest original; where none can be had (bytes were lost) it is the text as far as restored. ASCII
    texts are never garbled: no chain changes them. Null and empty texts: false, and as they are. Repeated rows: a row
    each. An empty table gives no rows. refs: a bounded table of trusted texts, on which the margin is validated.
    """
    source = require(df, id_col, text_col)
    if trained is None:
        trained = train(source.select(text_col), refs, ref_col)
    shared = df.sparkSession.sparkContext.broadcast(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, margin = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                garbled, best = restore(model, part.column(1).to_pylist(), margin)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(garbled, pa.bool_()), pa.array(best, pa.string())], ["id", "garbled", "restored"])

    return source.mapInArrow(run, "id bigint, garbled boolean, restored string")
