"""Text functions as Spark expressions; only Unicode normalization leaves the JVM."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# White space as Python sees it (also U+001C to U+001F, U+0085 and all separators).
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
LATIN_WORD = r"(?<![\p{L}\p{N}_])[a-zA-Z]+(?![\p{L}\p{N}_])"
CJK = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]"
# The four patterns of boilerplate.
SPAM = {
    "url": rf"www\.{NOT_SPACE}+\.{NOT_SPACE}+",
    "email": rf"{NOT_SPACE}+@{NOT_SPACE}+\.{NOT_SPACE}+",
    "call": rf"(?iu)(?:buy|sell|click|free|win){SPACE}+now",
    "non_ascii": r"[^\x00-\x7F]{20,}",
}


def bound(value: Column, then) -> Column:
    """then(value) with the value computed once: inside a lambda an expression would be computed for every element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def squeeze(text: Column) -> Column:
    """White space collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def strip(text: Column) -> Column:
    """White space of any kind taken off both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


# Typographic signs and what they become.
_PLAIN = str.maketrans({"‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "﻿": None} | {chr(c): None for c in [*range(0, 9), 11, *range(14, 32), *range(127, 160)] if c != 0x85})


def fix_text(text: str) -> str:
    """Entities, curly quotes and control characters in plain form, then NFKC. Mojibake is left to its own operator."""
    if "&" in text and ";" in text:
        text = html.unescape(text)
    return unicodedata.normalize("NFKC", text.translate(_PLAIN))


@F.pandas_udf(StringType())
def normalize(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else t if t.isascii() and "&" not in t and t.isprintable() else fix_text(t))


def clean_text(text: Column) -> Column:
    """fix_text and squeeze. Null stays null."""
    return squeeze(normalize(text))


def count_words(text: Column) -> Column:
    """Chinese characters plus words of ASCII letters that touch no other word character."""
    return (F.regexp_count(text, F.lit(CJK)) + F.regexp_count(text, F.lit(LATIN_WORD))).cast("bigint")


def is_mostly_ascii(text: Column, threshold: float = 0.8) -> Column:
    """Whether the share of ASCII characters reaches the threshold; true for an empty text."""
    return F.when(F.length(text) == 0, F.lit(True)).otherwise(F.length(F.regexp_replace(text, r"[^\x00-\x7F]", "")) / F.length(text) >= threshold)


def words(text: Column) -> Column:
    """Lower-case words between white space."""
    return F.filter(F.split(F.lower(text), SPACE + "+"), lambda w: w != "")


def has_repeated_ngrams(text: Column, n: int = 4, max_repeat: int = 3) -> Column:
    """Whether one of the overlapping n-grams of words comes max_repeat times or more; false below n * max_repeat words."""

    def again(grams: Column) -> Column:
        return F.exists(F.sequence(F.lit(0), F.size(grams) - max_repeat), lambda i: F.get(grams, i) == F.get(grams, i + (max_repeat - 1)))

    def several(grams: Column) -> Column:
        # Hardly any text has equal n-grams at all: only those that have enough of them are sorted.
        equal = F.size(grams) - F.size(F.array_distinct(grams))
        return F.when(equal < max_repeat - 1, F.lit(False)).otherwise(bound(F.sort_array(grams), again))

    def test(tokens: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(tokens, i, n)))
        return F.when(F.size(tokens) < n * max_repeat, F.lit(False)).otherwise(bound(grams, several))

    return F.when(F.length(text) < 2 * n * max_repeat - 1, F.lit(False)).otherwise(bound(words(text), test))


def spam_flag(text: Column, name: str) -> Column:
    """Whether the pattern of that name is found; what every match holds is looked for first, as patterns cost more."""
    needed = {
        "url": F.contains(text, F.lit("www.")),
        "email": F.contains(text, F.lit("@")),
        "call": F.contains(F.lower(text), F.lit("now")),
        "non_ascii": F.octet_length(text) - F.length(text) >= 20,
    }
    return needed[name] & text.rlike(SPAM[name])


def is_spam(text: Column) -> Column:
    found = [spam_flag(text, name) for name in SPAM]
    return found[0] | found[1] | found[2] | found[3]


def md5_hex(value: Column) -> Column:
    return F.md5(value)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def shingles(text: Column, k: int = 3) -> Column:
    """Overlapping k-grams of words; fewer than k words stand alone; none for an empty text."""

    def cut(tokens: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - (k - 1)), lambda i: F.concat_ws(" ", F.slice(tokens, i, k)))
        return F.when(F.size(tokens) < k, tokens).otherwise(grams)

    return bound(words(text), cut)


def prefix_key(text: Column, size: int = 40) -> Column:
    """The first `size` characters (code points) of the raw text."""
    return F.substring(text, 1, size)


def noun_phrase(text: Column) -> Column:
    """Without outer white space, final stops and one leading article, in lower case."""
    bare = F.regexp_replace(strip(text), r"\.+\z", "")
    return F.lower(F.regexp_replace(bare, rf"(?i)^(a|an|the){SPACE}+", ""))
