"""The same results in DuckDB's SQL, for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"

# Every window of 35 words as text; those that occur twice, the words they cover, the rest.
REPEATED_WORDS = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents
), windows AS (
  SELECT row, place, array_to_string(words[place:place + 34], ' ') AS content
  FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS place FROM texts)
), twice AS (
  SELECT content FROM windows GROUP BY content HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT row, unnest(range(place, place + 35)) AS place FROM windows JOIN twice USING (content)
), each AS (
  SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n
  FROM each ANTI JOIN covered USING (row, place) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""

# Every window of 200 bytes; maximal runs of the bytes they cover, and what lies between.
REPEATED_BYTES = """
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS body FROM documents
), windows AS (
  SELECT row, place, body[place:place + 199] AS content
  FROM (SELECT row, body, unnest(range(1, octet_length(body) - 198)) AS place FROM texts)
), twice AS (
  SELECT content FROM windows GROUP BY content HAVING count(*) > 1
), repeated AS (
  SELECT row, place, coalesce(place > 200 + lag(place) OVER (PARTITION BY row ORDER BY place), true) AS opens
  FROM windows JOIN twice USING (content)
), numbered AS (
  SELECT row, place, sum(opens::INT) OVER (PARTITION BY row ORDER BY place) AS run FROM repeated
), runs AS (
  SELECT row, run, min(place) AS first, max(place) + 200 AS after FROM numbered GROUP BY row, run
), gaps AS (
  SELECT row, lag(after, 1, 1) OVER (PARTITION BY row ORDER BY run) AS first, first AS after FROM runs
  UNION ALL
  SELECT row, coalesce(max(after), 1), octet_length(any_value(body)) + 1 FROM texts LEFT JOIN runs USING (row) GROUP BY row
), kept AS (
  SELECT row, string_agg(hex(body[gaps.first:gaps.after - 1]), '' ORDER BY gaps.first) AS rest
  FROM gaps JOIN texts USING (row) WHERE gaps.after > gaps.first GROUP BY row
), removed AS (
  SELECT row, count(*) AS n_spans, sum(after - first) AS n_removed FROM runs GROUP BY row
)
SELECT doc_id, octet_length(body)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(from_hex(coalesce(rest, ''))) AS kept_sha256
FROM texts LEFT JOIN kept USING (row) LEFT JOIN removed USING (row)
"""

# Sets of four-word shingles; links by their common shingles; the smallest id reached.
NEAR_DUPLICATES = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT row, array_to_string(words[place:place + 3], ' ') AS shingle
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - 2, 2))) AS place FROM texts WHERE len(words) > 0)
), sizes AS (
  SELECT row, count(*) AS n FROM shingles GROUP BY row
), common AS (
  SELECT a.row AS a, b.row AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.row <> b.row GROUP BY a.row, b.row
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
), reached AS (
  SELECT row, row AS other FROM texts
  UNION
  SELECT reached.row, b FROM reached JOIN links ON links.a = reached.other
), least AS (
  SELECT reached.row, min(texts.doc_id) AS component_id FROM reached JOIN texts ON texts.row = reached.other
  GROUP BY reached.row
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM texts LEFT JOIN sizes USING (row) JOIN least USING (row)
"""

# The checksum of a text's bytes, from its definition: a byte is mixed in, then eight shifts.
_CRC32 = """xor(4294967295, list_reduce(
  flatten([[4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [-ord(c) - 1, 0, 0, 0, 0, 0, 0, 0, 0]))]),
  lambda crc, x: CASE WHEN x < 0 THEN xor(crc, -x - 1) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END))"""


def _framed(field: str) -> str:
    return f"coalesce(strlen(({field})::VARCHAR) || ':' || ({field})::VARCHAR, '-')"


def _row_hash(n_chars: str) -> str:
    return "sha256(" + " || ".join(_framed(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# One level per step of a recursion, first per language and then over the subroots; the
# siblings of a row are the other nodes under the parents on its way up.
MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_row_hash("n_chars")} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 THEN {_row_hash("n_chars + 1")} END AS tampered
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), nodes AS (
  SELECT lang, 0 AS level, place, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (max(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, place // 2
), subroots AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS seat FROM nodes WHERE n = 1
), crown AS (
  SELECT 0 AS level, seat AS place, subroot AS hash, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (max(n) + 1) // 2
  FROM crown WHERE n > 1 GROUP BY level, place // 2
), steps AS (
  SELECT row, 0 AS half, own.level, own.place % 2 = 1 AS is_left, coalesce(other.hash, '') AS hash
  FROM leaves JOIN nodes own ON own.lang IS NOT DISTINCT FROM leaves.lang AND own.n > 1 AND own.place = leaves.place >> own.level
  LEFT JOIN nodes other ON other.lang IS NOT DISTINCT FROM own.lang AND other.level = own.level AND other.place = xor(own.place, 1)
  UNION ALL
  SELECT row, 1, own.level, own.place % 2 = 1, coalesce(other.hash, '')
  FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
  JOIN crown own ON own.n > 1 AND own.place = seat >> own.level
  LEFT JOIN crown other ON other.level = own.level AND other.place = xor(own.place, 1)
), ways AS (
  SELECT row, string_agg(hash, '' ORDER BY half, level) AS siblings,
    list((CASE WHEN is_left THEN '<' ELSE '>' END) || hash ORDER BY half, level) AS way
  FROM steps GROUP BY row
), folded AS (
  SELECT doc_id, leaf, subroot, (SELECT hash FROM crown WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_concat([coalesce(tampered, leaf)], coalesce(way, [])),
      lambda own, step: CASE WHEN step[1] = '<' THEN sha256(step[2:] || own) ELSE sha256(own || step[2:]) END) AS folded_root
  FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang LEFT JOIN ways USING (row)
)
SELECT *, folded_root = root AS verified FROM folded
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

# Every document's score for every item, then the best ten.
SEARCH = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, text FROM documents
), counts AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest({_TERMS}) AS term FROM texts) GROUP BY row, term
), lengths AS (
  SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths
), asked AS (
  SELECT DISTINCT item_id, text AS question, unnest({_TERMS}) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts WHERE term IN (SELECT term FROM asked) GROUP BY term), totals
), scores AS (
  SELECT item_id, question, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (row), totals
  GROUP BY item_id, question, row
)
SELECT item_id, row_number() OVER (PARTITION BY item_id, question ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores JOIN texts USING (row) WHERE score > 0
QUALIFY rank <= 10
"""

ORACLES = {
    "op4_repeated_bytes": REPEATED_BYTES,
    "op7_repeated_words": REPEATED_WORDS,
    "op8_near_tensored": NEAR_DUPLICATES,
    "op11_lexical_signatures": SEARCH,
    "op13_merkle_intervals": MERKLE,
}
