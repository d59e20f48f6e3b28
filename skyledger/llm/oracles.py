"""Check statements for the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS k, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, source_size * 2.0::DOUBLE AS cap,
        ([3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s
), r AS (
    SELECT *, cap / weight AS ratio FROM w
), l AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM r
), t AS (
    SELECT source, source_size, least(cap, (max(level) OVER ()) * weight) AS target FROM l
), p AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS quota,
        coalesce(sum(d.size) OVER (PARTITION BY d.source
            ORDER BY substr(md5('mix|' || coalesce(d.doc_id::VARCHAR, '') || '|' || d.k), 1, 13), d.doc_id, d.k, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (greatest(0, least(size, quota - before)) + greatest(0, least(size, quota - before - source_size)))::BIGINT AS taken
FROM p
"""

OP9 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), k AS (
    SELECT doc_id, w, unnest(CASE WHEN len(w) >= 3 THEN range(1, len(w) - 1) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM d
), g AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] ELSE array_to_string(w, ' ') END AS shingle FROM k
), n AS (
    SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), i AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
    SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), u AS (
    SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION SELECT reach.a, u.b FROM reach JOIN u ON reach.b = u.a
), c AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

OP10 = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS w FROM documents
), m AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS w FROM benchmark
), bw AS (
    SELECT item_id, w, least(len(w), 13) AS n, unnest(range(greatest(len(w) - 12, least(len(w), 1)))) AS i FROM m
), b AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase FROM bw
), dn AS (
    SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM d, (SELECT DISTINCT n FROM b)
), dw AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS phrase FROM dn
), h AS (
    SELECT dw.doc_id, dw.i, dw.n, b.item_id FROM dw JOIN b ON dw.n = b.n AND dw.phrase = b.phrase
), hits AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM h) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS items_sha256 FROM h GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _canonical(text: str, spellings: list[tuple[str, str]]) -> str:
    """The canonical form of a text as an expression."""
    low = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    copyright = r"^[^0-9a-z]*((copyright|\(c\)|©)([^a-z].*)?|all rights reserved[^0-9a-z]*)$"
    own = f"array_to_string(list_filter(string_split({low}, chr(10)), lambda line: NOT regexp_matches(line, '{copyright}')), ' ')"
    plain = rf"trim(regexp_replace({own}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'))"
    out = rf"regexp_replace(' ' || {plain} || ' ', ' v([0-9])', ' v \1', 'g')"
    for old, new in spellings:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim({out})"


def op5(known: list[tuple[str, str]], spellings: list[tuple[str, str]]) -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in known)
    return f"""
WITH k AS (
    SELECT {_canonical("t", spellings)} AS c, min(license) AS license FROM (VALUES {rows}) v(license, t) GROUP BY 1
), d AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), u AS (
    SELECT r, true AS whole, text FROM d 
    UNION ALL
    SELECT r, false, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
), h AS (
    SELECT r, min(license) FILTER (whole) AS license, count(*) FILTER (NOT whole) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
    FROM (SELECT r, whole, {_canonical("text", spellings)} AS c FROM u) JOIN k USING (c) GROUP BY r
)
SELECT doc_id, license, coalesce(n, 0)::BIGINT AS n_license_lines, coalesce(licenses, '') AS licenses FROM d LEFT JOIN h USING (r)
"""


def _rank(*parts: str) -> str:
    """A number below 2^52 from an md5 of texts."""
    return f"CAST('0x' || substr(md5({' || '.join(parts)}), 1, 13) AS BIGINT)"


#: DuckDB has no crc32, so it is computed byte by byte from a table made by its polynomial.
OP8 = f"""
WITH t AS (
    SELECT list(v ORDER BY n) AS crc FROM (
        SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS v FROM range(256) r(n))
), d AS (
    SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h, coalesce(doc_id::VARCHAR, '') AS k FROM documents
), b AS (
    SELECT doc_id, k, strlen(text) + 1 AS size, list_transform(range(strlen(text)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS bytes,
        list_transform(range(9), lambda s: -ln(({_rank("'shard '", "s", "'|'", "k")} + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)) AS cost FROM d
), c AS (
    SELECT doc_id, k, size, xor(list_reduce(bytes, lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) AS text_crc32,
        CAST(list_position(cost[1:8], list_min(cost[1:8])) - 1 AS INTEGER) AS shard, CAST(list_position(cost, list_min(cost)) - 1 AS INTEGER) AS grown_shard FROM b, t
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY {_rank("'slot|'", "k", "'|'", "text_crc32::VARCHAR")}, doc_id, text_crc32) - 1 AS slot, grown_shard
FROM c
"""


def op6(ngram_shares: dict[int, float], line_share: float) -> str:
    lengths = [3, *ngram_shares]
    keys = ", ".join(f"CASE WHEN count(*) OVER w{n} = {n} THEN string_agg(word, ' ') OVER w{n} END AS k{n}" for n in lengths)
    windows = ", ".join(f"w{n} AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)" for n in lengths)
    later = ", ".join(f"k{n} IS NOT NULL AND row_number() OVER (PARTITION BY r, k{n} ORDER BY p) > 1 AS f{n}" for n in ngram_shares)
    covered = ", ".join(f"bool_or(f{n}) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    sums = ", ".join(f"coalesce(sum(c) FILTER (c{n}), 0) AS s{n}" for n in ngram_shares)
    shares = ", ".join(f"coalesce(s{n}, 0)::DOUBLE / greatest(chars, 1) AS dup_{n}gram_share" for n in ngram_shares)
    passed = " AND ".join(f"dup_{n}gram_share <= {limit}::DOUBLE" for n, limit in ngram_shares.items())
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), s AS (
    SELECT r, regexp_extract_all(text, '{_WORD}') AS ws FROM d
), w AS (
    SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM s
), k AS (
    SELECT r, p, length(word) AS c, {keys} FROM w WINDOW {windows}
), f AS (
    SELECT r, p, c, k3 IS NOT NULL AND count(*) OVER (PARTITION BY r, k3) > 1 AS f3, {later} FROM k
), v AS (
    SELECT r, c, {covered} FROM f
), a AS (
    SELECT r, count(*) AS n, sum(c) AS chars, count(*) FILTER (c3) AS n_repeat, {sums} FROM v GROUP BY r
), l AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d
), e AS (
    SELECT r, list_sum(list_transform(regexp_extract_all(line, '{_WORD}'), lambda x: length(x))) AS c, row_number() OVER (PARTITION BY r, line ORDER BY i) AS copy
    FROM l WHERE regexp_matches(line, '{_WORD}')
), b AS (
    SELECT r, count(*) FILTER (copy > 1) AS n_dup, coalesce(sum(c) FILTER (copy > 1), 0) AS held FROM e GROUP BY r
), m AS (
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(held, 0)::DOUBLE / greatest(coalesce(chars, 0), 1) AS dup_line_share,
        {shares.replace("greatest(chars, 1)", "greatest(coalesce(chars, 0), 1)")}
    FROM d LEFT JOIN a USING (r) LEFT JOIN b USING (r)
), j AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND dup_line_share <= {line_share}::DOUBLE AND {passed} AS kept FROM j
"""


OP11 = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), q AS (
    SELECT item_id, row_number() OVER () AS q, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark
), s AS (
    SELECT count(*) AS docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0
), m AS (
    SELECT doc_id, r, 100 - 75 + (75 * len(ts) * docs) // total AS m FROM d, s WHERE len(ts) > 0
), qt AS (
    SELECT q, t, count(*) AS c FROM (SELECT q, unnest(ts) AS t FROM q) GROUP BY q, t
), p AS (
    SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) SEMI JOIN qt USING (t) GROUP BY r, t
), w AS (
    SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s
), i AS (
    SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS worth FROM p JOIN w USING (t) JOIN m USING (r)
), f AS (
    SELECT q, r, sum(c * worth)::BIGINT AS score FROM qt JOIN i USING (t) GROUP BY q, r HAVING sum(c * worth) > 0
), o AS (
    SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM f JOIN m USING (r)
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o JOIN q USING (q) WHERE rank <= 10
"""
