"""SQL of the corpus queries for DuckDB, where SQL can express the operator on whole tables.

The models, codings and packings of this subpackage have none, nor has the word join of problem 1: their tests compare
them with brute force, an exact round trip or held-out rows instead.
"""

from __future__ import annotations

from .canon import INVISIBLE, JOINER, JOINER_MARK, LIGATURES, LOOKALIKE, LOOKALIKE_AS, SPACES, WIDE, WIDE_AS

# A record: a JSON object with a string caption and a score that is a number or absent. Numbers beyond doubles don't count.
_RECORDS = r"""
lines AS (SELECT line_id, raw_line::JSON AS r FROM raw_lines WHERE json_valid(raw_line)),
records AS (
  SELECT line_id, json_extract_string(r, '$.image') AS image, CASE WHEN json_exists(r, '$.score') THEN json_extract_string(r, '$.score')::DOUBLE ELSE 1.0 END AS score,
    regexp_replace(lower(nfc_normalize(json_extract_string(r, '$.caption'))), '[^\p{L}\p{N}]', '', 'g') AS letters
  FROM lines WHERE json_type(r) = 'OBJECT' AND json_type(r, '$.caption') = 'VARCHAR' AND (NOT json_exists(r, '$.score') OR json_type(r, '$.score') IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'HUGEINT'))
),
marked AS (SELECT line_id, min(line_id) OVER same AS first_id, count(*) OVER same AS copies FROM records WHERE isfinite(score) WINDOW same AS (PARTITION BY image, score, letters))"""

# Hashes of all runs of 160 characters: of 1, 2, 4 and so on to 128, each from two of half the length, and of 128 and 32.
_RUNS = """
h1 AS (SELECT doc_id, i, size, hash(c) AS h FROM (SELECT doc_id, length(text) AS size, unnest(string_split(text, '')) AS c, unnest(range(1, length(text) + 1)) AS i FROM documents WHERE length(text) >= 160)),"""
for _k in (1, 2, 4, 8, 16, 32, 64):
    _RUNS += f"""
h{2 * _k} AS (SELECT doc_id, i, size, hash(h, lead(h, {_k}) OVER (PARTITION BY doc_id ORDER BY i)) AS h FROM h{_k}),"""
_RUNS += """
runs AS (SELECT DISTINCT a.doc_id, hash(a.h, b.h) AS run FROM h128 a JOIN h32 b ON a.doc_id = b.doc_id AND b.i = a.i + 128 WHERE a.i <= a.size - 159)"""


def _same_look() -> str:
    """Captions mapped to prototypes as in the operator; composition stands for the collation, which is equal for them."""
    text = f"regexp_replace(caption, '{JOINER}([\\x{{2600}}-\\x{{27bf}}\\x{{1f000}}-\\x{{1faff}}])', '{JOINER_MARK}\\1', 'g')"
    # Characters without a counterpart at the end of the list are deleted.
    text = f"translate({text}, '{WIDE + SPACES + INVISIBLE + JOINER}', '{WIDE_AS.replace(chr(39), chr(39) * 2) + ' ' * len(SPACES)}')"
    for ligature, letters in LIGATURES.items():
        text = f"replace({text}, '{ligature}', '{letters}')"
    form = f"nfc_normalize(translate({text}, '{LOOKALIKE}', '{LOOKALIKE_AS}'))"
    return f"""
WITH forms AS (SELECT pair_id, caption, {form} AS form FROM pairs WHERE regexp_matches({form}, '[^\\s]'))
SELECT a.pair_id AS pair_id_a, b.pair_id AS pair_id_b FROM forms a JOIN forms b ON a.form = b.form AND a.pair_id < b.pair_id AND a.caption <> b.caption"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_pictures": """
WITH hashes AS (SELECT image_id AS id, ('0x' || phash)::UBIGINT AS h FROM images WHERE regexp_full_match(phash, '[0-9a-fA-F]{16}'))
SELECT a.id AS id_a, b.id AS id_b FROM hashes a JOIN hashes b ON a.id < b.id AND bit_count(xor(a.h, b.h)) <= 5""",
        "p3_found": _same_look(),
        "p6_found": f"WITH {_RECORDS} SELECT first_id, line_id AS copy_id FROM marked WHERE line_id <> first_id",
        "p6_collapsed": f"WITH {_RECORDS} SELECT first_id, copies FROM marked WHERE line_id = first_id",
        "p10_found": f"WITH {_RUNS} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id < b.doc_id",
    }
