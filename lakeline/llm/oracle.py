"""DuckDB SQL of the queries that SQL can express.

The others learn a model, use a tokenizer or a hash that SQL lacks; tests/llm compares them
with brute force, exact round trips or held-out rows.
"""

from __future__ import annotations

_RENDEZVOUS = """
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, encode(coalesce(text, '')) AS bytes FROM documents
), sized AS (
  SELECT n, doc_id, octet_length(bytes) + 1 AS size, hex(bytes) AS digits FROM d
), checked AS (
  SELECT n, doc_id, size, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(size - 1),
      lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda e, k: xor(e >> 1, 3988292384 * (e & 1))))) AS text_crc32
  FROM sized
), draws AS (
  SELECT n, s, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || s), 1, 13))::BIGINT
                + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS draw
  FROM d, range(17) AS shards(s)
), placed AS (
  SELECT n, arg_min(s, -ln(draw)) FILTER (WHERE s < 16) AS shard,
         arg_min(s, -ln(draw)) AS grown_shard
  FROM draws GROUP BY n
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law,
       shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1
         AS slot,
       grown_shard::INTEGER AS grown_shard
FROM checked JOIN placed USING (n)
"""

_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

_DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce({_WORDS}, []) AS words FROM documents
), item AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, {_WORDS} AS words FROM benchmark
  WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, list_slice(words, i::BIGINT, (i + 9)::BIGINT) AS phrase
  FROM item, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
), sizes AS (
  SELECT DISTINCT len(phrase) AS size FROM windows
), runs AS (
  SELECT n, i, size, list_slice(words, i::BIGINT, (i + size - 1)::BIGINT) AS phrase
  FROM d, sizes, unnest(range(1, len(words) - size + 2)) AS t(i)
), hits AS (
  SELECT DISTINCT n, i, size, item_id FROM runs JOIN windows USING (phrase)
), places AS (
  SELECT n, count(DISTINCT place) AS n_hit
  FROM hits, unnest(range(i, i + size)) AS t(place) GROUP BY n
), items AS (
  SELECT n, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT n, item_id FROM hits) GROUP BY n
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (n) LEFT JOIN items USING (n)
"""

_MIXING = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))
           ::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':0') AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), ordered AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights,
         row_number() OVER (ORDER BY source_size * 6 // weight, source NULLS LAST) AS place
  FROM sources
  WINDOW before AS (ORDER BY source_size * 6 // weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), share AS (
  SELECT place, rest, weights FROM ordered
  WHERE 3 * source_size * weights >= rest * weight ORDER BY place LIMIT 1
), aims AS (
  SELECT source, source_size,
         CASE WHEN ordered.place < share.place THEN (3 * source_size)::DOUBLE
              ELSE share.rest::DOUBLE * weight / share.weights::DOUBLE END AS target
  FROM ordered, share
), parts AS (
  SELECT source, source_size, target, round(target)::BIGINT // greatest(source_size, 1) AS epochs,
         round(target)::BIGINT % greatest(source_size, 1) AS rest
  FROM aims
), rows AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY draw, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM d
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - done)))::BIGINT AS taken
FROM rows JOIN parts ON rows.source IS NOT DISTINCT FROM parts.source
"""

_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(*columns: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in columns) + ")"


# CRC-32 of the digits of doc_id, byte by byte.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)),
      lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda e, k: xor(e >> 1, 3988292384 * (e & 1)))))"""

_MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0
              THEN {_leaf('doc_id', 'source', 'lang', '(n_chars + 1)', 'text')} END AS claimed
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER () AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS size
  FROM leaves
), tree(lang, level, place, hash, size) AS (
  SELECT lang, 0, place, leaf, size FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)),
         (any_value(size) + 1) // 2
  FROM tree WHERE size > 1 GROUP BY lang, level, place // 2
), subroots AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
         count(*) OVER () AS size
  FROM tree WHERE size = 1
), crown(level, place, hash, size) AS (
  SELECT 0, place, subroot, size FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)),
         (any_value(size) + 1) // 2
  FROM crown WHERE size > 1 GROUP BY level, place // 2
), climb(n, lang, place, size, level, folded, beside) AS (
  SELECT n, lang, place, size, 0, coalesce(claimed, leaf), '' FROM placed
  UNION ALL
  SELECT n, c.lang, c.place // 2, (c.size + 1) // 2, c.level + 1,
         sha256(CASE WHEN c.place % 2 = 1 THEN coalesce(t.hash, '') || folded
                     ELSE folded || coalesce(t.hash, '') END), beside || coalesce(t.hash, '')
  FROM climb c LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM c.lang AND t.level = c.level
    AND t.place = xor(c.place, 1)
  WHERE c.size > 1
), above(n, place, size, level, folded, beside) AS (
  SELECT n, s.place, s.size, 0, folded, beside
  FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.size = 1
  UNION ALL
  SELECT n, a.place // 2, (a.size + 1) // 2, a.level + 1,
         sha256(CASE WHEN a.place % 2 = 1 THEN coalesce(t.hash, '') || folded
                     ELSE folded || coalesce(t.hash, '') END), beside || coalesce(t.hash, '')
  FROM above a LEFT JOIN crown t ON t.level = a.level AND t.place = xor(a.place, 1)
  WHERE a.size > 1
)
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, folded AS folded_root,
       folded = root AS verified
FROM placed JOIN above USING (n)
JOIN subroots s ON s.lang IS NOT DISTINCT FROM placed.lang,
     (SELECT hash AS root FROM crown WHERE size = 1)
WHERE above.size = 1
"""

ORACLE: dict[str, str] = {
    "op2_rendezvous_shards": _RENDEZVOUS,
    "op8_decontamination": _DECONTAMINATION,
    "op11_mixing": _MIXING,
    "op13_manifest": _MANIFEST,
}
