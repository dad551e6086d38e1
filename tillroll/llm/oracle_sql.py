"""DuckDB SQL for the operators that SQL can express, written apart from them."""

# CRC-32 of ASCII or UTF-8 text: a table of 256 steps, taken byte by byte.
CRC = """
steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1
             THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b)
  )
)"""


def crc(text):
    """The CRC-32 of a text, given the table ``steps``."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    octets = f"[{byte} FOR i IN range(octet_length(encode({text})))]"
    return (
        f"xor(list_reduce({octets}, lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295),"
        " 4294967295)"
    )


# Every diagonal of equal words, as islands of neighbours.
OP12_SQL = f"""
WITH {CRC}, split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         {crc("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, steps
), plan AS (
  SELECT doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS tiled,
         (h // 10) % greatest(len(words), 1) AS a, h // 10 % 8 AS m
  FROM split
), laid AS (
  SELECT doc_id, n, CASE WHEN tiled THEN
           [words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + m)) END + 1]
            FOR i IN range(n)] ELSE words END AS words
  FROM plan
), word AS (
  SELECT doc_id, n, unnest(words) AS w, unnest(range(n)) AS i FROM laid
), equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i AND 2 * (y.i - x.i) <= x.n
), diagonal AS (
  SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island, i FROM equal
), stretch AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS size FROM diagonal GROUP BY doc_id, q, island
), run AS (
  SELECT doc_id, s, size, min(q) AS q FROM stretch
  WHERE size >= greatest(12, 2 * q) GROUP BY doc_id, s, size
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM run
), kept AS (
  SELECT word.doc_id, string_agg(w, ' ' ORDER BY word.i) AS text
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i
  WHERE gone.i IS NULL GROUP BY word.doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS runs
  FROM run GROUP BY doc_id
), longest AS (
  SELECT * FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, s, q) = 1
)
SELECT laid.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, size AS length, q AS period,
       1000 * size // q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM laid LEFT JOIN kept USING (doc_id) LEFT JOIN listed USING (doc_id)
LEFT JOIN longest USING (doc_id)
"""

OP13_SQL = f"""
WITH {CRC}, split AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), target AS (
  SELECT unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM benchmark
), word AS (
  SELECT doc_id, unnest(words) AS w FROM split
), kind AS (
  SELECT w, {crc("w")} % 10000 AS bucket
  FROM (SELECT w FROM word UNION SELECT w FROM target) AS k, steps
), of_all AS (
  SELECT bucket, count(*) AS s FROM word JOIN kind USING (w) GROUP BY bucket
), of_target AS (
  SELECT bucket, count(*) AS t FROM target JOIN kind USING (w) GROUP BY bucket
), total AS (
  SELECT (SELECT count(*) FROM word) AS ss, (SELECT count(*) FROM target) AS tt
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
           (coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM of_all LEFT JOIN of_target USING (bucket), total
), weighed AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM word JOIN kind USING (w) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
           / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM split LEFT JOIN weighed USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed
"""
