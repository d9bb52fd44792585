"""The queries in SQL, where SQL can say them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_quality_rules"] = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM split, range(1, 1000000) AS r(i) WHERE false
), places AS (
  SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3
), grams AS (
  SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM places
), repeated AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM grams) WHERE n >= 2
), covered AS (
  SELECT k, count(DISTINCT i + d) AS n FROM repeated, range(0, 3) AS t(d) GROUP BY k
), stats AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(regexp_extract_all(text, '\p{L}')) AS letters, len(regexp_extract_all(text, '\p{Lu}')) AS capitals
  FROM split LEFT JOIN covered USING (k)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_dup_lines > 3 * n_lines OR 2 * letters < word_chars OR 2 * capitals > word_chars) AS kept
FROM judged
""".replace("""windows AS (
  SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM split, range(1, 1000000) AS r(i) WHERE false
), """, "")

# Without the checksum, which SQL here has no function for; used by the tests.
SHARDING_WITHOUT_CHECKSUM = """
WITH RECURSIVE sizes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, text, coalesce(md5(text), '') AS digest FROM documents
), placed AS (
  SELECT *, sum(size) OVER o AS cum, row_number() OVER o - 1 AS spot FROM sizes
  WINDOW o AS (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)
), ends AS MATERIALIZED (
  SELECT CAST(max(cum) AS BIGINT) AS e, CAST(sum(size) AS BIGINT) AS g FROM placed GROUP BY digest
), bounds AS (
  SELECT max(e) AS total, max(g) AS largest, list(e ORDER BY e) AS l FROM ends
), search(lo, hi, total, l) AS (
  SELECT greatest(largest, CAST(ceil(total / 8.0) AS BIGINT)),
         greatest(largest, CAST(ceil(total / 8.0) AS BIGINT)) + largest, total, l FROM bounds
  UNION ALL
  SELECT CASE WHEN fits THEN lo ELSE mid + 1 END, CASE WHEN fits THEN mid ELSE hi END, total, l
  FROM (
    SELECT lo, hi, total, l, mid, total - list_reduce(
      list_prepend(0::BIGINT, [0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda pos, x: coalesce(list_max(list_filter(l, lambda e: e <= pos + mid)), pos)) <= mid AS fits
    FROM (SELECT *, (lo + hi) // 2 AS mid FROM search WHERE lo < hi)
  )
), best AS (SELECT lo AS c, total, l FROM search WHERE lo = hi),
cuts(k, pos) AS (
  SELECT 0, 0::BIGINT FROM best
  UNION ALL
  SELECT k + 1, coalesce(list_max(list_filter(l, lambda e: e <= pos + c)), pos) FROM cuts, best WHERE k < 7
), shards AS (
  SELECT doc_id, size, text, spot, (SELECT count(*) FROM cuts WHERE k > 0 AND cuts.pos < cum) AS shard FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(NULL AS BIGINT) AS text_crc32, 'bytes' AS law,
       CAST(shard AS INTEGER) AS shard,
       CAST(spot - min(spot) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM shards
"""

ORACLES["op10_source_mix"] = """
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat_ws('|', '17', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS queue
  FROM documents
), sources AS (
  SELECT queue, CAST(sum(size) AS BIGINT) AS s, [5, 2, 1][(row_number() OVER (ORDER BY queue) - 1) % 3 + 1] AS w
  FROM sizes GROUP BY queue
), total AS (SELECT CAST(sum(s) AS BIGINT) AS budget FROM sources),
filled(round, full_queues) AS (
  SELECT 0, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT round + 1, (SELECT list(queue) FROM sources WHERE list_contains(full_queues, queue)
      OR w * (budget - (SELECT coalesce(sum(3 * s), 0) FROM sources WHERE list_contains(full_queues, queue)))
         > 3 * s * (SELECT sum(w) FROM sources WHERE NOT list_contains(full_queues, queue)))
  FROM filled, total WHERE round <= (SELECT count(*) FROM sources)
), fullest AS (SELECT coalesce(full_queues, []) AS q FROM filled ORDER BY round DESC LIMIT 1),
targets AS (
  SELECT queue, s, CASE WHEN list_contains(q, queue) THEN CAST(3 * s AS DOUBLE) ELSE
    CAST((budget - (SELECT coalesce(sum(3 * s), 0) FROM sources WHERE list_contains(q, queue))) * w AS DOUBLE)
    / CAST((SELECT sum(w) FROM sources WHERE NOT list_contains(q, queue)) AS DOUBLE) END AS target
  FROM sources, total, fullest
), queued AS (
  SELECT doc_id, size, h, queue, s, target, row_number() OVER () AS k,
         sum(size) OVER (PARTITION BY queue ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS c
  FROM sizes JOIN targets USING (queue)
), copies AS (
  SELECT *, CAST(turn * s + c AS DOUBLE) / target AS finish FROM queued, range(0, 3) AS t(turn) WHERE target > 0
), taken AS (
  SELECT k, sum(size) AS words FROM (
    SELECT *, sum(size) OVER (ORDER BY finish, queue, turn, h, doc_id NULLS FIRST, size
                              ROWS UNBOUNDED PRECEDING) AS used FROM copies
  ), total WHERE used <= budget GROUP BY k
)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target, CAST(coalesce(words, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (k)
"""

ORACLES["op9_jaccard_join"] = """
WITH RECURSIVE split AS (
  SELECT doc_id, row_number() OVER () AS k,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), grams AS (
  SELECT DISTINCT k, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT k, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM split WHERE len(words) > 0)
), sizes AS (SELECT k, count(*) AS n FROM grams GROUP BY k),
links AS (
  SELECT a.k AS u, b.k AS v FROM grams a JOIN grams b ON a.g = b.g AND a.k <> b.k GROUP BY a.k, b.k
  HAVING 5 * count(*) >= 4 * ((SELECT n FROM sizes WHERE k = a.k) + (SELECT n FROM sizes WHERE k = b.k) - count(*))
), reach(k, other) AS (
  SELECT k, k FROM split UNION SELECT reach.k, links.v FROM reach JOIN links ON links.u = reach.other
), classes AS (
  SELECT reach.k, min(s.doc_id) AS class_id, count(*) AS class_size
  FROM reach JOIN split s ON s.k = reach.other GROUP BY reach.k
), degrees AS (SELECT u AS k, count(*) AS n FROM links GROUP BY u)
SELECT split.doc_id, class_id, CAST(class_size AS BIGINT) AS class_size, CAST(coalesce(n, 0) AS BIGINT) AS n_links
FROM split JOIN classes USING (k) LEFT JOIN degrees USING (k)
"""

_ITEM_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES["op11_benchmark_decontamination"] = f"""
WITH worded AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, {_ITEM_WORDS} AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS l
  FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), windows AS MATERIALIZED (
  SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS passage
  FROM (SELECT item, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM items)
), places AS (
  SELECT k, i, l, array_to_string(w[i:i + l - 1], ' ') AS passage
  FROM (SELECT k, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM worded, (SELECT DISTINCT l FROM windows) WHERE len(w) >= l)
), hits AS MATERIALIZED (
  SELECT k, i, l, item FROM places JOIN windows USING (l, passage)
), covered AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT k, i, l FROM hits))
  GROUP BY k
), named AS (
  SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT k, item FROM hits WHERE item IS NOT NULL) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AS contaminated
FROM worded LEFT JOIN covered USING (k) LEFT JOIN named USING (k)
"""


def _spelled(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_spelled, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# The checksum of a short text, bit by bit.
_CRC32_OF_ID = """xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
    lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC32_OF_ID} % 5 = 0
         THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM leaves
), nodes(source, lvl, pos, n, digest) AS (
  SELECT source, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 16, n
), tops AS MATERIALIZED (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper(lvl, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY lvl, pos // 16, n
), siblings AS MATERIALIZED (
  SELECT a.source, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
  GROUP BY a.source, a.lvl, a.pos
), upper_siblings AS MATERIALIZED (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM upper a JOIN upper b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 GROUP BY a.lvl, a.pos
), climb(rid, source, lvl, pos, n, digest, proof) AS (
  SELECT rid, source, 0, pos, n, coalesce(tampered, leaf), '' FROM placed
  UNION ALL
  SELECT c.rid, c.source, c.lvl + 1, c.pos // 16, (c.n + 15) // 16, sha256(s.l || c.digest || s.r), c.proof || s.l || s.r
  FROM climb c JOIN siblings s ON c.source IS NOT DISTINCT FROM s.source AND c.lvl = s.lvl AND c.pos = s.pos WHERE c.n > 1
), rise(rid, lvl, pos, n, digest, proof) AS (
  SELECT c.rid, 0, t.pos, t.n, c.digest, c.proof FROM climb c JOIN tops t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n = 1
  UNION ALL
  SELECT c.rid, c.lvl + 1, c.pos // 16, (c.n + 15) // 16, sha256(s.l || c.digest || s.r), c.proof || s.l || s.r
  FROM rise c JOIN upper_siblings s ON c.lvl = s.lvl AND c.pos = s.pos WHERE c.n > 1
)
SELECT p.doc_id, p.leaf, t.digest AS subroot, u.digest AS root, sha256(r.proof) AS proof_sha256,
       r.digest AS folded_root, r.digest = u.digest AS verified
FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
JOIN (SELECT * FROM rise WHERE n = 1) r ON p.rid = r.rid, (SELECT digest FROM upper WHERE n = 1) u
"""


def _vector_codes() -> str:
    distance = "list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def assigned(books: str) -> str:
        return (f"SELECT x.rid, x.p, any_value(x.part) AS part, CAST(min(CAST({distance} AS BIGINT) * 16 + b.entry) AS BIGINT) AS best "
                f"FROM parts x JOIN {books} b ON x.p = b.p GROUP BY x.rid, x.p")

    steps = []
    for i in range(6):
        steps.append(f"""a{i} AS MATERIALIZED ({assigned(f"b{i}")}
), b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(m.part, b.part) AS part FROM b{i} b LEFT JOIN (
    SELECT p, entry, list(mean ORDER BY spot) AS part FROM (
      SELECT p, entry, spot, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
      FROM (SELECT p, best % 16 AS entry, unnest(part) AS x, generate_subscripts(part, 1) AS spot FROM a{i})
      GROUP BY p, entry, spot) GROUP BY p, entry) m USING (p, entry)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(e, lambda x: CAST(floor(x * 4096) AS BIGINT)) AS v
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL)
  WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, vec_id, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS part FROM kept, range(8) AS t(p)
), b0 AS MATERIALIZED (
  SELECT p, j - 1 AS entry, part
  FROM (SELECT p, part, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS j FROM parts) WHERE j <= 16
), {", ".join(steps)}, final AS MATERIALIZED ({assigned("b6")}
), coded AS (
  SELECT rid, string_agg(printf('%02x', best % 16), '' ORDER BY p) AS code, CAST(sum(best // 16) AS BIGINT) AS error
  FROM final GROUP BY rid
), books AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM b6
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


ORACLES["op13_vector_codes"] = _vector_codes()
