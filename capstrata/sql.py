"""SQL for DuckDB of the core queries. What needs Unicode normalization has none."""

from __future__ import annotations

from .operators.augment import SYNONYM_SEED, SYNONYMS

_S = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
_NS = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"
_CAPTION = "coalesce(caption, '')"
_CLEAN = rf"trim(regexp_replace(coalesce(caption, ''), '{_S}+', ' ', 'g'), ' ')"


def _words(text: str, fold: str = "lower") -> str:
    return f"list_filter(regexp_split_to_array({fold}({text}), '{_S}+'), lambda w: w <> '')"


def _phrase(text: str) -> str:
    bare = rf"regexp_replace(regexp_replace({text}, '^{_S}+|{_S}+$', '', 'g'), '\.+$', '')"
    return f"lower(regexp_replace({bare}, '^(?i:a|an|the){_S}+', ''))"


_SPAM = {
    "url": rf"www\.{_NS}+\.{_NS}+",
    "email": rf"{_NS}+@{_NS}+\.{_NS}+",
    "call": rf"(?i)(?:buy|sell|click|free|win){_S}+now",
    "non_ascii": r"[^\x00-\x7F]{20,}",
}
_COUNT = r"(len(regexp_extract_all({0}, '[\x{{4e00}}-\x{{9fff}}\x{{3400}}-\x{{4dbf}}]')) + len(list_filter(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[a-zA-Z]+'))))"
_GRAMS = "list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))"
_CLEANED = f"SELECT pair_id, {_CLEAN} AS c FROM pairs"
_REPEATS = f"""
grams AS (SELECT pair_id, unnest({_GRAMS}) AS g FROM (SELECT pair_id, {_words('c')} AS w FROM cleaned) WHERE len(w) >= 12),
again AS (SELECT DISTINCT pair_id FROM (SELECT pair_id, g FROM grams GROUP BY pair_id, g HAVING count(*) >= 3))"""
_SPAMS = " OR ".join(f"regexp_matches(c, '{p}')" for p in _SPAM.values())
_REASON = f"""
WITH cleaned AS ({_CLEANED}), {_REPEATS},
counted AS (SELECT c.pair_id, c.c, {_COUNT.format('c.c')} AS n, a.pair_id IS NOT NULL AS again FROM cleaned c LEFT JOIN again a USING (pair_id))
SELECT pair_id, CASE WHEN length(c) < 10 THEN 'too_short' WHEN length(c) > 512 THEN 'too_long' WHEN n < 3 THEN 'too_few_words' WHEN n > 100 THEN 'too_many_words'
WHEN {_SPAMS} THEN 'spam_pattern' WHEN again THEN 'repeated_ngrams' ELSE 'ok' END AS reason FROM counted"""
_IMAGE = "CASE WHEN coalesce(width, 0) < 64 OR coalesce(height, 0) < 64 THEN 'image_too_small' WHEN greatest(width, height) / least(width, height) > 3.0 THEN 'bad_aspect_ratio' ELSE 'ok' END"
_PREFIX = "substring(coalesce(caption, ''), 1, 40)"
_DRAW = "md5('42:' || pair_id || ':' || {})"
_SYNONYM_MAP = "MAP {" + ", ".join(f"'{k}': [{', '.join(repr(x) for x in v)}]" for k, v in SYNONYMS.items()) + "}"
_NUMBER = "('0x' || substr({}, {}, 8))::UBIGINT"
_SHINGLES = "CASE WHEN len(w) < 3 THEN w ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END"


_SIMHASHED = f"""
words AS (SELECT pair_id, {_words(_CAPTION)} AS w FROM pairs),
hashed AS (SELECT pair_id, list_transform({_SHINGLES}, lambda s: ('0x' || substr(md5(s), 17, 16))::UBIGINT) AS h FROM words),
simhashed AS (SELECT pair_id, list_sum(list_transform(range(0, 64), lambda i: CASE WHEN 2 * len(list_filter(h, lambda x: (x >> i::UBIGINT) & 1 = 1)) > len(h) THEN 1::UBIGINT << i::UBIGINT ELSE 0::UBIGINT END))::UBIGINT AS h FROM hashed)"""


def _greedy(p: str, rows: str, threshold: int) -> str:
    """Common tables, {p}_dropped last: the rows (ord, h) that fall when each row in order is kept unless it is near a kept one.

    Equal hashes collapse to their first row; the rest goes through a recursion with one step for each row that is near
    another one, which carries the list of those kept so far.
    """
    return f"""
{p}_firsts AS (SELECT h, min(ord) AS ord FROM {rows} WHERE h IS NOT NULL GROUP BY h),
{p}_edges AS (SELECT a.ord AS src, b.ord AS dst FROM {p}_firsts a JOIN {p}_firsts b ON a.ord < b.ord AND bit_count(xor(a.h, b.h)) <= {threshold}),
{p}_nodes AS (SELECT ord, row_number() OVER (ORDER BY ord) AS k FROM (SELECT src AS ord FROM {p}_edges UNION SELECT dst FROM {p}_edges)),
{p}_near AS (SELECT n.k, list(m.k) AS earlier FROM {p}_edges e JOIN {p}_nodes n ON n.ord = e.dst JOIN {p}_nodes m ON m.ord = e.src GROUP BY n.k),
{p}_steps(k, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT n.k, CASE WHEN coalesce(list_has_any(s.kept, b.earlier), false) THEN s.kept ELSE list_append(s.kept, n.k) END
  FROM {p}_steps s JOIN {p}_nodes n ON n.k = s.k + 1 LEFT JOIN {p}_near b ON b.k = n.k),
{p}_kept AS (SELECT unnest(kept) AS k FROM (SELECT kept FROM {p}_steps ORDER BY k DESC LIMIT 1)),
{p}_dropped AS (SELECT ord FROM {rows} r WHERE h IS NOT NULL AND ord NOT IN (SELECT ord FROM {p}_firsts) UNION ALL SELECT ord FROM {p}_nodes WHERE k NOT IN (SELECT k FROM {p}_kept))"""


_PHASH = "CASE WHEN regexp_full_match(phash, '[0-9a-fA-F]{16}') THEN ('0x' || phash)::UBIGINT END"
_FUNNEL = f"""
firsts AS (SELECT min(pair_id) AS pair_id FROM pairs GROUP BY coalesce(key, {_PREFIX})),
pictured AS (SELECT pair_id AS ord, {_PHASH} AS h FROM firsts JOIN pairs USING (pair_id) LEFT JOIN images ON pairs.image = images.image),
{_greedy('by_image', 'pictured', 5)},
{_SIMHASHED},
worded AS (SELECT pair_id AS ord, h FROM simhashed JOIN firsts USING (pair_id) WHERE pair_id NOT IN (SELECT ord FROM by_image_dropped)),
{_greedy('by_text', 'worded', 3)}"""


def oracle_sql() -> dict[str, str]:
    out = {
        "clean_whitespace": rf"SELECT pair_id, trim(regexp_replace(caption, '{_S}+', ' ', 'g'), ' ') AS cleaned FROM pairs",
        "word_count": f"WITH cleaned AS ({_CLEANED}) SELECT pair_id, {_COUNT.format('c')}::BIGINT AS n_words FROM cleaned",
        "mostly_ascii": r"SELECT pair_id, CASE WHEN length(c) = 0 THEN true ELSE length(regexp_replace(c, '[^\x00-\x7F]', '', 'g')) / length(c) >= 0.8 END AS ascii FROM (SELECT pair_id, coalesce(caption, '') AS c FROM pairs)",
        "repeated_ngrams": f"WITH cleaned AS ({_CLEANED}), {_REPEATS} SELECT c.pair_id, a.pair_id IS NOT NULL AS repeated FROM cleaned c LEFT JOIN again a USING (pair_id)",
        "spam_flags": f"WITH cleaned AS ({_CLEANED}) SELECT pair_id, " + ", ".join(f"regexp_matches(c, '{p}') AS {n}" for n, p in _SPAM.items()) + " FROM cleaned",
        "digests": "SELECT pair_id, md5(coalesce(caption, '')) AS md5, sha256(coalesce(caption, '')) AS sha256 FROM pairs",
        "shingle_count": f"SELECT pair_id, CASE WHEN len(w) < 3 THEN len(w) ELSE len(w) - 2 END AS n_shingles FROM (SELECT pair_id, {_words(_CAPTION)} AS w FROM pairs)",
        "prefix_keys": f"SELECT pair_id, {_PREFIX} AS prefix FROM pairs",
        "noun_phrase": f"SELECT pair_id, {_phrase(_CAPTION)} AS phrase FROM pairs",
        "text_reason": _REASON,
        "reason_funnel": f"SELECT reason, count(*) AS n FROM ({_REASON}) GROUP BY reason",
        "passing_captions": f"SELECT count(*) FILTER (reason = 'ok') AS passing FROM ({_REASON})",
        "image_reason": f"SELECT image_id, {_IMAGE} AS reason FROM images",
        "score_filter": "SELECT pair_id, score FROM pairs WHERE score >= 0.22 AND NOT isnan(score)",
        "language_filter": "SELECT pair_id, lang FROM pairs WHERE coalesce(lang IN ('en', 'zh-cn', 'zh-tw'), true)",
        "blocked_images": "SELECT pair_id FROM pairs WHERE image IS NULL OR image NOT IN (SELECT image FROM images WHERE phash IS NULL)",
        "quality_stats": f"""
WITH texts AS ({_REASON}), joined AS (SELECT t.reason AS text, {_IMAGE} AS image, p.score FROM pairs p JOIN texts t USING (pair_id) LEFT JOIN images i ON p.image = i.image),
staged AS (SELECT CASE WHEN text <> 'ok' THEN 'text' WHEN image <> 'ok' THEN 'image' WHEN NOT coalesce(score >= 0.22 AND NOT isnan(score), false) THEN 'clip' ELSE '' END AS stage FROM joined)
SELECT count(*) AS total, count(*) FILTER (stage = '') AS passed, count(*) FILTER (stage = 'text') AS failed_text, count(*) FILTER (stage = 'image') AS failed_image, count(*) FILTER (stage = 'clip') AS failed_clip FROM staged""",
        "exact_dedup": f"SELECT min(pair_id) AS pair_id FROM pairs GROUP BY coalesce(key, {_PREFIX})",
        "simhash": f"""
WITH words AS (SELECT pair_id, {_words(_CAPTION)} AS w FROM pairs),
hashed AS (SELECT pair_id, list_transform({_SHINGLES}, lambda s: ('0x' || substr(md5(s), 17, 16))::UBIGINT) AS h FROM words)
SELECT pair_id, lower(printf('%016x', list_sum(list_transform(range(0, 64), lambda i: CASE WHEN 2 * len(list_filter(h, lambda x: (x >> i::UBIGINT) & 1 = 1)) > len(h) THEN 1::UBIGINT << i::UBIGINT ELSE 0::UBIGINT END))::UBIGINT)) AS simhash FROM hashed""",
        "template_augment": f"""
WITH rows AS (SELECT pair_id, caption, unnest([0, 1, 2]) AS draw FROM pairs WHERE caption IS NOT NULL),
picked AS (SELECT *, {_NUMBER.format(_DRAW.format('draw'), 1)} % 5 AS k, {_phrase('caption')} AS np FROM rows)
SELECT pair_id, draw, CASE k WHEN 0 THEN caption WHEN 1 THEN 'A photo of ' || np || '.' WHEN 2 THEN 'An image showing ' || lower(caption) || '.' WHEN 3 THEN 'This picture depicts ' || np || '.' ELSE caption || ' — captured in a photograph.' END AS variant FROM picked""",
        "synonym_augment": rf"""
WITH words AS (SELECT pair_id, list_filter(regexp_split_to_array(caption, '{_S}+'), lambda w: w <> '') AS ws FROM pairs WHERE caption IS NOT NULL),
each AS (SELECT pair_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM words),
looked AS (SELECT *, regexp_replace(w, '[,.;:]+$', '') AS bare, md5('{42 + SYNONYM_SEED}:' || pair_id || ':' || i) AS d FROM each),
options AS (SELECT *, {_SYNONYM_MAP}[lower(bare)] AS o FROM looked),
picked AS (SELECT *, CASE WHEN o IS NOT NULL AND len(o) > 0 AND {_NUMBER.format('d', 1)} < {int(0.3 * 2**32)} THEN o[1 + ({_NUMBER.format('d', 9)} % len(o))::INT] END AS r FROM options),
done AS (SELECT pair_id, i, CASE WHEN r IS NULL THEN w ELSE (CASE WHEN w[1] <> lower(w[1]) THEN upper(r[1]) || r[2:] ELSE r END) || substr(w, length(bare) + 1) END AS x FROM picked)
SELECT p.pair_id, coalesce(s.v, '') AS variant FROM (SELECT pair_id FROM pairs WHERE caption IS NOT NULL) p LEFT JOIN (SELECT pair_id, string_agg(x, ' ' ORDER BY i) AS v FROM done GROUP BY pair_id) s USING (pair_id)""",
        "augmented_captions": "",
        "hamming_pairs": f"""
SELECT image_id, bit_count(xor(h, earlier))::BIGINT AS bits FROM (SELECT image_id, h, lag(h) OVER (PARTITION BY width, height ORDER BY image_id) AS earlier FROM (SELECT image_id, width, height, {_PHASH} AS h FROM images WHERE phash IS NOT NULL))
WHERE earlier IS NOT NULL AND h IS NOT NULL""",
        "image_dedup": f"WITH RECURSIVE hashes AS (SELECT image_id AS ord, {_PHASH} AS h FROM images), {_greedy('g', 'hashes', 5)} SELECT ord AS image_id FROM g_dropped",
        "text_dedup": f"WITH RECURSIVE {_SIMHASHED}, hashes AS (SELECT pair_id AS ord, h FROM simhashed), {_greedy('g', 'hashes', 3)} SELECT ord AS pair_id FROM g_dropped",
        "dedup_funnel": f"""
WITH RECURSIVE {_FUNNEL}
SELECT total, total - (SELECT count(*) FROM firsts) AS exact_dup, (SELECT count(*) FROM by_image_dropped) AS image_dup, (SELECT count(*) FROM by_text_dropped) AS text_dup,
(SELECT count(*) FROM firsts) - (SELECT count(*) FROM by_image_dropped) - (SELECT count(*) FROM by_text_dropped) AS kept FROM (SELECT count(*) AS total FROM pairs)""",
        "jsonl_records": r"""
WITH parsed AS (SELECT line_id, raw_line::JSON AS r FROM raw_lines WHERE json_valid(raw_line) AND regexp_matches(raw_line, '^\s*\{')),
fields AS (SELECT line_id, r ->> '$.image' AS image, coalesce(r ->> '$.caption', '') AS caption, r ->> '$.score' AS given FROM parsed)
SELECT * FROM (SELECT line_id, image, caption, CASE WHEN given IS NULL THEN 1.0 ELSE try_cast(given AS DOUBLE) END AS score FROM fields) WHERE score >= 0 AND NOT isnan(score)""",
        "cosine_filter": """
WITH each AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centres AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(x) AS m FROM each GROUP BY label, i) GROUP BY label),
scored AS (SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], centre) AS score FROM embeddings JOIN centres USING (label))
SELECT vec_id, round(score, 6) AS score FROM scored WHERE score >= 0.05 AND NOT isnan(score)""",
        "run_stats_latest": "SELECT shard, run_id, loaded, passed, kept FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY started_at DESC, run_id DESC) AS k FROM run_stats) WHERE k = 1",
    }
    out["augmented_captions"] = f"""
WITH templated AS ({out['template_augment']}), synonyms AS ({out['synonym_augment']}), given AS (SELECT pair_id, caption FROM pairs WHERE caption IS NOT NULL),
made AS (SELECT pair_id, -1 AS place, caption AS new FROM given
UNION ALL SELECT t.pair_id, t.draw, t.variant FROM templated t JOIN given USING (pair_id) WHERE t.draw < 2 AND t.variant <> caption
UNION ALL SELECT s.pair_id, 9, s.variant FROM synonyms s JOIN given USING (pair_id) WHERE s.variant <> caption)
SELECT pair_id, (row_number() OVER (PARTITION BY pair_id ORDER BY place) - 1)::INT AS variant, new AS caption FROM made"""
    return out
