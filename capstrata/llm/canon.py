"""Problem 3: texts that look the same in print but are made of other characters, brought to one form.

In SQL, look-alikes of every text are mapped to one prototype each (width forms, ligatures, kinds of space, invisible
characters, letters of other scripts), the mapped values are grouped under the accent- and case-sensitive Unicode
collation (which makes stored forms of an accent equal), one member of each class is chosen, and is joined back.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach_group, materialize, pair_rows, require

# Letters that look like a Latin one, by script; and what they look like.
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮԌԜԚаеѕіјорсухһԁԛԝӏүёїЁЇӓӧӒӦ"
CYRILLIC_AS = "ABESIJKMHOPCTYXYGWQaesijopcyxhdqwlyëïËÏäöÄÖ"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹανορϲϳυικόάίϊΐύ"
GREEK_AS = "ABEZHIKMNOPTYXCavopcjuikóáíïḯú"
ARMENIAN = "օոսՕՏհցզ"
ARMENIAN_AS = "onuOShgq"
LATIN = "ɑɡıſʀ"
LATIN_AS = "agisR"
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufe00\ufe01\ufe02\ufe03\ufe04\ufe05\ufe06\ufe07\ufe08\ufe09\ufe0a\ufe0b\ufe0c\ufe0d\ufe0e\ufe0f\ufeff"
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
#: A joiner between emoji changes the picture; elsewhere it is invisible. The collation would pass over it, this mark stays.
JOINER, JOINER_MARK = "\u200d", "\ue00d"
#: Control characters that the collation passes over are kept apart by these.
CONTROLS = "".join(map(chr, [*range(0, 9), *range(14, 32), *range(127, 160)]))

_wide = {c: n for c in map(chr, range(0xFF01, 0xFFEF)) if len(n := unicodedata.normalize("NFKC", c)) == 1 and n != c}
WIDE, WIDE_AS = "".join(_wide), "".join(_wide.values())
#: By rule: characters that are stored in another way too, and the first character of that way. Hangul has its own rule.
_stored = {c: d[0] for c in map(chr, [*range(0xC0, 0xAC00), *range(0xF900, 0x30000)]) if (d := unicodedata.normalize("NFD", c)) != c}
STORED, STORED_AS = "".join(_stored), "".join(_stored.values())
#: What the coarse form leaves out: marks, format characters, and the fillers and the later letters of Hangul syllables.
PASSED_OVER = r"[\p{Mn}\p{Mc}\p{Cf}\x{115f}-\x{11ff}\x{3164}\x{ffa0}]"
LOOKALIKE, LOOKALIKE_AS = CYRILLIC + GREEK + ARMENIAN + LATIN, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + LATIN_AS


def _class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


def tidy(text: Column) -> Column:
    """Width, ligatures, spaces and invisible characters in one form; letters keep their script."""
    joined = F.regexp_replace(text, r"\x{200d}(?=[\x{2600}-\x{27bf}\x{1f000}-\x{1faff}])", JOINER_MARK)
    plain = F.translate(joined, WIDE + SPACES + INVISIBLE + JOINER, WIDE_AS + " " * len(SPACES))
    for ligature, letters in LIGATURES.items():
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    return plain


def mapped(text: Column) -> Column:
    """The text with each look-alike replaced by its prototype: equal for texts that look the same, up to stored accents."""
    marks = "".join(chr(0xE100 + i) for i in range(len(CONTROLS)))
    return F.translate(tidy(text), LOOKALIKE + CONTROLS, LOOKALIKE_AS + marks)


def oddness(text: Column) -> Column:
    """How much of a text is in an uncommon form: the canonical member is the one with least."""
    letters = r"[\p{IsCyrillic}\p{IsGreek}\p{IsArmenian}]"
    odd = F.length(text) - F.length(F.translate(text, WIDE + SPACES + INVISIBLE + JOINER + "".join(LIGATURES) + LATIN, ""))
    return odd + F.regexp_count(text, F.lit(r"\p{Mn}")) + F.regexp_count(text, F.lit(rf"\p{{IsLatin}}(?={letters})|{letters}(?=\p{{IsLatin}})"))


def coarse(form: Column) -> Column:
    """The mapped text without accents: equal wherever the collation finds two forms equal, and cheap to hash. A Hangul
    syllable stands for all."""
    bare = F.regexp_replace(F.translate(form, STORED, STORED_AS), PASSED_OVER, "")
    return F.regexp_replace(bare, r"[\x{1100}-\x{115e}\x{ac00}-\x{d7a3}]", "\uac00")


def _candidates(df: DataFrame, id_col: str, text_col: str, keep_rest: bool) -> DataFrame:
    """(id, text, form, n): rows whose coarse form has two different texts or more; n is null for the others, if kept.

    Only these reach the collation, whose comparisons cost a hundred times a hash.
    """
    rows = require(df, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    plain = F.col("text").rlike(r"^[\x20-\x7e]*$")
    rows = rows.withColumn("form", F.when(plain, F.col("text")).otherwise(mapped(F.col("text"))))
    rows = rows.withColumn("key", F.xxhash64(F.when(plain, F.col("text")).otherwise(coarse(F.col("form")))))
    known = rows.where(F.col("text").isNotNull() & F.trim("form").rlike(r"\S"))
    code = F.xxhash64("text")
    groups = known.groupBy("key").agg(F.min(code).alias("low"), F.max(code).alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high").select("key", "n")
    if not keep_rest:
        return materialize(attach_group(known, groups, ["key"]).select("id", "text", "form", "n"), "looks")
    blank = F.col("text").isNull() | ~F.coalesce(F.trim("form").rlike(r"\S"), F.lit(False))
    rest = rows.where(blank).unionByName(known.join(groups, "key", "left_anti")).withColumn("n", F.lit(None).cast("bigint"))
    several = attach_group(known, groups, ["key"])
    return materialize(several.unionByName(rest).select("id", "text", "form", "n"), "forms")


def same_look(df: DataFrame, id_col: str = "pair_id", text_col: str = "caption") -> DataFrame:
    """(id_a, id_b): rows, id_a < id_b, whose texts look the same and are not equal strings.

    Null and blank texts (white space and invisible characters only) never count. Equal texts of several rows come out
    in every pair with an unequal one. An empty table gives no rows.
    """
    rows = _candidates(df, id_col, text_col, False).withColumn("form", F.collate("form", "UNICODE")).drop("n")
    classes = rows.groupBy("form").agg(F.min("text").alias("low"), F.max("text").alias("high"), F.min("id").alias("class"), F.count(F.lit(1)).alias("n"))
    members = attach_group(rows, classes.where("low <> high").select("form", "class", "n"), ["form"])
    return pair_rows(materialize(members.select("id", "text", "class", "n"), "classes"), ["class"], "id", other="text")


def canonical(df: DataFrame, id_col: str = "pair_id", text_col: str = "caption") -> DataFrame:
    """(id_col, canonical): one form of every text. The canonical member of a class is its least odd text, the smallest
    among equals; it, and every text without a partner, is then brought into the form of `repair`.

    Null stays null, empty and blank texts are tidied only. Repeated rows: a row each.
    """
    rows = _candidates(df, id_col, text_col, True)
    several = rows.where("n is not null").withColumn("form", F.collate("form", "UNICODE")).drop("n")
    best = F.min(F.struct(oddness(F.col("text")).alias("odd"), F.col("text"))).alias("best")
    classes = several.groupBy("form").agg(best, F.count(F.lit(1)).alias("n"))
    joined = attach_group(several, classes, ["form"]).select("id", F.col("best.text").alias("text"))
    everything = joined.unionByName(rows.where("n is null").select("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else repair(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "canonical"])

    return everything.mapInArrow(run, f"`{id_col}` {dict(everything.dtypes)['id']}, canonical string")


# The same mapping for texts in Python, word by word: operators on words call it inside their Arrow step.

_tidy_table = {ord(c): None for c in INVISIBLE} | {ord(c): " " for c in SPACES} | {ord(a): b for a, b in zip(WIDE, WIDE_AS)} | {ord(k): v for k, v in LIGATURES.items()}
_to_latin = {ord(a): b for a, b in zip(LOOKALIKE, LOOKALIKE_AS)}
_to_cyrillic = {ord(b): a for a, b in zip(reversed(CYRILLIC), reversed(CYRILLIC_AS))} | {ord(a): c for a, b in zip(GREEK + ARMENIAN + LATIN, GREEK_AS + ARMENIAN_AS + LATIN_AS) for c, d in zip(CYRILLIC, CYRILLIC_AS) if d == b}
_untidy = re.compile("[" + "".join(map(re.escape, INVISIBLE + JOINER + SPACES + "".join(LIGATURES))) + "\uff01-\uffee]")
_loose_joiner = re.compile(JOINER + "(?![\u2600-\u27bf\U0001f000-\U0001faff])")
_foreign = re.compile(r"[Ͱ-֏ɑɡıſʀ]")
_other_letters = re.compile("[A-Za-z\u00c0-\u03ff\u0530-\u058f]")
_word = re.compile(r"[^\W\d_]+")
_cyrillic_only = re.compile(f"[{''.join(c for c in map(chr, range(0x400, 0x530)) if c not in CYRILLIC)}]")
_latin_only = re.compile(f"[{''.join(c for c in map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x250)]) if c not in CYRILLIC_AS)}]")


def repair(text: str) -> str:
    """One consistent form of a text: tidied, composed, and each word in one script.

    A word with letters of its script alone is left in it; a word of look-alikes only goes with the text's words.
    """
    if text.isascii():
        return text
    if _untidy.search(text):
        text = _loose_joiner.sub("", text.translate(_tidy_table))
    text = unicodedata.normalize("NFC", text)
    if not _foreign.search(text) or (not _other_letters.search(text) and _cyrillic_only.search(text)):
        return text
    cyrillic, latin = len(_cyrillic_only.findall(text)), len(_latin_only.findall(text))

    def one_script(found: re.Match) -> str:
        word = found.group()
        if not _foreign.search(word) and not (cyrillic and _to_cyrillic):
            return word
        c, r = len(_cyrillic_only.findall(word)), len(_latin_only.findall(word))
        if c == r:
            c, r = (c, r) if c + r == 0 else (cyrillic, latin)
            if c + r == 0:
                c, r = cyrillic, latin
        return word.translate(_to_cyrillic if c > r else _to_latin)

    return unicodedata.normalize("NFC", _word.sub(one_script, text))
