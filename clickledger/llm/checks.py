"""SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

CHECKS: dict[str, str] = {}


def _grams(n: int) -> str:
    """Rows of doc_id, pos and gram (n words in a row) from `texts`, which has doc_id and words."""
    following = ", ".join(f"lead(word, {k}) OVER text" for k in range(1, n))
    return f"""SELECT doc_id, pos, gram FROM (
        SELECT doc_id, pos, concat_ws(' ', word, {following}) AS gram, lead(word, {n - 1}) OVER text AS last
        FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts)
        WINDOW text AS (PARTITION BY doc_id ORDER BY pos)
    ) WHERE last IS NOT NULL"""

CHECKS["op1_mixing"] = rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len({WORDS})::BIGINT AS size,
           md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth
    FROM sized GROUP BY source
), weighted AS (
    SELECT *, [3.0::DOUBLE, 1.0, 2.0][((nth - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS stop
    FROM sources
), filling AS (
    -- share what is left among the open sources; close those that reach their stop, until none does
    SELECT 0 AS round, CAST([] AS BIGINT[]) AS closed,
           (SELECT 1.5::DOUBLE * sum(source_size) / sum(weight) FROM weighted) AS level
    UNION ALL
    SELECT round + 1, stopped, (SELECT (1.5::DOUBLE * sum(source_size)
               - coalesce(sum(stop) FILTER (list_contains(stopped, nth)), 0))
               / sum(weight) FILTER (NOT list_contains(stopped, nth)) FROM weighted)
    FROM (SELECT round, closed, level, (SELECT coalesce(list(nth), []) FROM weighted
                                        WHERE list_contains(closed, nth) OR level * weight > stop) AS stopped
          FROM filling)
    WHERE len(stopped) > len(closed)
), targets AS (
    SELECT source, source_size,
           CASE WHEN list_contains(closed, nth) THEN stop ELSE level * weight END AS target
    FROM weighted, (SELECT arg_max(closed, round) AS closed, arg_max(level, round) AS level FROM filling)
), drawn AS (
    SELECT s.*, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
           row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.place) AS nth,
           ('0x' || substr(md5('mix/' || coalesce('s' || s.source, 'n')), 1, 12))::BIGINT::DOUBLE
               / 281474976710656.0::DOUBLE AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM (SELECT *, least(floor(nth * rate + start) - floor((nth - 1) * rate + start), ceil(rate))::BIGINT AS copies
      FROM drawn)
"""

CHECKS["op4_substring_dedup"] = rf"""
WITH texts AS (
    SELECT doc_id, {WORDS} AS words FROM documents
), windows AS (
    {_grams(13)}
), firsts AS (
    SELECT gram, min(doc_id) AS first FROM windows GROUP BY gram HAVING min(doc_id) < max(doc_id)
), hits AS (
    SELECT w.doc_id, list(DISTINCT pos) AS places
    FROM windows w JOIN firsts f USING (gram) WHERE w.doc_id > f.first GROUP BY w.doc_id
), gone AS (
    SELECT doc_id, list_distinct(flatten(list_transform(places, lambda p: range(p, p + 13)))) AS removed FROM hits
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(len(g.removed), 0)::BIGINT AS n_removed,
       sha256(array_to_string([w FOR w, i IN t.words IF g.removed IS NULL OR NOT list_contains(g.removed, i)], ' ')) AS kept_sha256
FROM texts t LEFT JOIN gone g USING (doc_id)
"""

CHECKS["op5_warc"] = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), sized AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), holders AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN holder END AS refers_to
FROM holders
"""

# fixed values: the most common words of each language
_COMMON = """MAP {
  'de': ['der', 'die', 'und', 'in', 'den', 'von', 'zu', 'das', 'mit', 'sich', 'auf', 'ist'],
  'en': ['the', 'of', 'and', 'to', 'a', 'in', 'is', 'that', 'for', 'with', 'was', 'on'],
  'es': ['de', 'la', 'que', 'el', 'en', 'y', 'los', 'se', 'del', 'las', 'un', 'por'],
  'fr': ['de', 'la', 'le', 'et', 'les', 'des', 'en', 'un', 'du', 'une', 'que', 'est'],
  '*': ['der', 'die', 'und', 'the', 'of', 'and', 'de', 'la', 'que', 'le']}"""


def _kept(pattern: str) -> str:
    return f"length(regexp_replace(text, '{pattern}', '', 'g'))::BIGINT"


_CLASSES = [
    r"[^\x20\x09-\x0D]+", "[^A-Z]+", "[^0-9]+", """[^.,;:!?''"()-]+""",
    r"[^#$%&*+/<=>@\[\]\\^_`{|}~]+", r"[\x00-\x7F]+",
]
_DISTANCE = """sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 - (count(*) - 1) / (8 * max(size) * ln(2)), 0))"""

CHECKS["op3_quality"] = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words,
           CASE WHEN lang IN ('de', 'en', 'es', 'fr') THEN lang ELSE '*' END AS language
    FROM documents
), windows AS (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM ({_grams(5)})
), again AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(range(pos, pos + 5)) AS place FROM windows WHERE n > 1) GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), counted AS (
    SELECT doc_id, language, len(words)::BIGINT AS n_words, length(text)::BIGINT AS n_chars,
           [{", ".join(_kept(x) for x in _CLASSES)}] AS classes, {_kept("[^#*$%&|<>]+")} AS n_symbols,
           [len(list_filter(words, lambda w: w = c)) FOR c IN ({_COMMON})[language]] AS common,
           len(list_filter(words, lambda w: list_contains(({_COMMON})[language], w))) AS frequent,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(again.n, 0)::BIGINT AS n_repeat_words
    FROM texts JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)
), bins AS (
    SELECT doc_id, language, 'classes' AS kind, unnest(range(7)) AS bin, n_chars AS size, n_chars >= 150 AS fit,
           unnest(list_append(classes, n_chars - list_sum(classes))) AS n, n_chars >= 150 AND n_words >= 100 AS normal
    FROM counted
    UNION ALL
    SELECT doc_id, language, 'words', unnest(range(len(common) + 1)), n_words, n_words >= 100,
           unnest(list_append(common, n_words - frequent)), n_chars >= 150 AND n_words >= 100
    FROM counted
), shares AS (
    SELECT *, CASE WHEN sum(n) OVER own > 0 THEN n / sum(n) OVER own ELSE 0 END AS p FROM bins
    WINDOW own AS (PARTITION BY doc_id, kind)
), usual AS (
    SELECT language, kind, bin, avg(p) AS q FROM shares WHERE normal AND (language <> '*' OR kind = 'words') GROUP BY ALL
    UNION ALL
    SELECT '*', kind, bin, avg(p) FROM shares WHERE normal AND kind = 'classes' GROUP BY ALL
), far AS (
    SELECT doc_id, kind, {_DISTANCE} AS distance
    FROM shares JOIN usual USING (language, kind, bin) WHERE fit GROUP BY doc_id, kind
), judged AS (
    SELECT doc_id, bool_and(distance <= CASE kind WHEN 'classes' THEN 0.26 ELSE 0.24 END) AS near FROM far GROUP BY doc_id
)
SELECT doc_id, n_words, n_chars - classes[1] AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(near, true) AS kept
FROM counted LEFT JOIN judged USING (doc_id)
"""

CHECKS["op7_near_dedup"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT doc_id, unnest(CASE WHEN len(words) = 1 THEN words ELSE list_distinct(
        [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) END) AS pair
    FROM texts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM sets a JOIN sets b ON a.pair = b.pair AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT doc_id, b FROM reached JOIN links ON a = other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def _centroid_rounds() -> str:
    """Ten rounds of moving the centroids, as steps c0 to c10 with number and vector."""
    steps = []
    for k in range(10):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT row, arg_min(c.number, (c.far, c.number)) AS number FROM (
        SELECT row, number, list_sum(list_transform(list_zip(v, centre),
               lambda x: (x[1] - x[2])::HUGEINT * (x[1] - x[2]))) AS far
        FROM whole, c{k}) c GROUP BY row
), m{k} AS (
    SELECT number, list(mean ORDER BY place) AS centre FROM (
        SELECT number, place, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
        FROM (SELECT number, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM whole JOIN a{k} USING (row))
        GROUP BY number, place) GROUP BY number
), c{k + 1} AS MATERIALIZED (
    SELECT number, coalesce(m.centre, c.centre) AS centre FROM c{k} c LEFT JOIN m{k} m USING (number)
)""")
    return ", ".join(steps)


CHECKS["op11_centroids"] = f"""
WITH whole AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS number, v AS centre
    FROM whole ORDER BY number LIMIT 8
), {_centroid_rounds()}, last AS (
    SELECT row, min(far) AS distance, arg_min(number, (far, number)) AS number FROM (
        SELECT row, number, list_sum(list_transform(list_zip(v, centre),
               lambda x: (x[1] - x[2])::HUGEINT * (x[1] - x[2]))) AS far
        FROM whole, c10) GROUP BY row
)
SELECT vec_id, number::INT AS cluster, distance::BIGINT AS distance,
       sum(distance) OVER (PARTITION BY number)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM last JOIN whole USING (row) JOIN c10 USING (number)
"""

# h of a document: CRC-32 of the id's digits, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

CHECKS["op12_runs"] = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, {WORDS} AS words, {_CRC32} AS h FROM documents
), cut AS (
    SELECT *, (h // 10) % nullif(len(words), 0) AS a, 3 + (h // 10) % 8 AS k FROM texts
), changed AS MATERIALIZED (
    SELECT row, doc_id, CASE WHEN h % 10 = 0 AND len(words) > 0
        THEN [words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(words) - a) // k) END + 1] FOR i IN range(len(words))]
        ELSE words END AS words
    FROM cut
), placed AS (
    SELECT row, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM changed
), grams AS (
    SELECT row, pos, md5(concat_ws(' ', word, {", ".join(f"lead(word, {k}) OVER text" for k in range(1, 16))})) AS gram,
           lead(word, 15) OVER text AS last
    FROM placed WINDOW text AS (PARTITION BY row ORDER BY pos)
), twins AS (
    -- a run repeats at least sixteen words one period on
    SELECT x.row, x.pos, y.pos - x.pos AS q
    FROM (SELECT * FROM grams WHERE last IS NOT NULL) x JOIN (SELECT * FROM grams WHERE last IS NOT NULL) y
      ON x.row = y.row AND x.gram = y.gram AND x.pos < y.pos
), islands AS (
    SELECT row, q, min(pos) AS s, max(pos) + 16 + q AS e
    FROM (SELECT *, pos - row_number() OVER (PARTITION BY row, q ORDER BY pos) AS island FROM twins)
    GROUP BY row, q, island HAVING max(pos) + 16 + q - min(pos) >= greatest(24, 3 * q)
), runs AS MATERIALIZED (
    SELECT * FROM islands x WHERE NOT EXISTS (
        SELECT 1 FROM islands y WHERE y.row = x.row AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND y.e >= x.e)
), gone AS (
    SELECT row, list_distinct(flatten(list(range(s + q, e)))) AS places FROM runs GROUP BY row
), strongest AS (
    SELECT row, q, s, e FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY (e - s)::DOUBLE / q DESC, s, q) = 1
), listed AS (
    SELECT row, count(*) AS n, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines
    FROM runs GROUP BY row
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_runs, s::BIGINT AS start, (e - s)::BIGINT AS length, q::BIGINT AS period,
       (1000 * (e - s) // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(CASE WHEN places IS NULL THEN array_to_string(words, ' ') ELSE
           array_to_string([w FOR w, i IN words IF NOT list_contains(places, i - 1)], ' ') END) AS collapsed_sha256
FROM changed LEFT JOIN listed USING (row) LEFT JOIN strongest USING (row) LEFT JOIN gone USING (row)
"""
