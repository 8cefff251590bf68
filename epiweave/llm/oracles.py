"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

# base 32 of a SHA-1 in hex: five hex digits are four letters
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST(('0x' || substr(sha1(payload), CAST(5 * (j // 4) + 1 AS BIGINT), 5)) AS INTEGER) >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31), 1) for j in range(32)], '')"""

OP8 = f"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS response FROM payloads GROUP BY payload)
SELECT p.page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes, {_BASE32.replace('payload', 'p.payload')} AS payload_digest,
    CASE WHEN p.page_id IS NOT DISTINCT FROM f.response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN p.page_id IS NOT DISTINCT FROM f.response THEN NULL ELSE f.response END AS refers_to
FROM payloads p JOIN firsts f USING (payload)
"""

OP4 = r"""
WITH item_words AS (
    SELECT item_id, [x for x in regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS run, least(10, len(w)) AS size
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
    SELECT row_number() OVER () AS row, doc_id, [x for x in regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
    SELECT row, i, size, array_to_string(w[i : i + size - 1], ' ') AS run
    FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
hits AS (SELECT r.row, r.i, r.size, x.item_id FROM runs r JOIN windows x USING (run, size)),
hit_words AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT row, i, size FROM hits)) GROUP BY row),
items AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY row)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (row) LEFT JOIN items i USING (row)
"""

OP11 = r"""
WITH texts AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS m FROM pieces) WHERE len(w) >= m),
counts AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
    SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[: k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS rest
    FROM (SELECT *, unnest(range(1, m)) AS k FROM counts WHERE m > 1)),
scores AS (
    SELECT c.lang, c.m, c.phrase, a, k, l.f AS l, r.f AS r, n, CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.first JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
survivors AS (
    SELECT * FROM least x WHERE NOT EXISTS (
        SELECT 1 FROM counts y WHERE y.lang = x.lang AND y.m > x.m AND y.f = x.a AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM survivors QUALIFY rank <= 2000
"""

# crc32 of the decimal doc_id, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)), CAST(4294967295 AS BIGINT)))"""

OP13 = rf"""
WITH own AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, {_CRC32} AS h FROM documents),
planned AS (SELECT *, len(w) AS n, h // 10 AS g FROM own),
bent AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM planned),
texts AS (
    SELECT row, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n),
        lambda i: w[CAST(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END AS BIGINT)]) END AS w
    FROM bent),
words AS (SELECT row, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
equal AS (SELECT x.row, y.i - x.i AS p, x.i FROM words x JOIN words y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 2),
stretches AS (
    SELECT row, min(i) AS s, count(*) + p AS len, p
    FROM (SELECT *, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS part FROM equal) GROUP BY row, p, part HAVING count(*) >= greatest(p, 12 - p)),
runs AS (SELECT row, s, len, min(p) AS p FROM stretches GROUP BY row, s, len),
found AS (
    SELECT row, count(*) AS n_runs, max(struct_pack(len := len, before := -s, less := -p)) AS best,
        string_agg(s || ',' || len || ',' || p || chr(10), '' ORDER BY s, p) AS lines FROM runs GROUP BY row),
dropped AS (SELECT DISTINCT row, unnest(range(s + p, s + len)) AS i FROM runs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS words FROM words ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT t.doc_id, coalesce(f.n_runs, 0) AS n_runs, CAST(-f.best.before AS BIGINT) AS start, CAST(f.best.len AS BIGINT) AS length, CAST(-f.best.less AS BIGINT) AS period,
    CAST(1000 * f.best.len // -f.best.less AS BIGINT) AS exponent_milli, sha256(coalesce(f.lines, '')) AS runs_sha256, sha256(coalesce(k.words, '')) AS collapsed_sha256
FROM texts t LEFT JOIN found f USING (row) LEFT JOIN kept k USING (row)
"""

ORACLES: dict[str, str] = {"op4_decontaminate": OP4, "op8_warc": OP8, "op11_phrases": OP11, "op13_periodic_runs": OP13}
