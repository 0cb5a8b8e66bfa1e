"""SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

EXACT_DEDUP = f"""
WITH d AS (
  SELECT doc_id, LENGTH(COALESCE(text, '')) AS chars,
    translate(COALESCE(text, ''), {WHITE}, '') AS body
  FROM documents),
g AS (
  SELECT doc_id, body,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
    COUNT(*) OVER (PARTITION BY body) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""

MIXING = """
WITH sized AS (
  SELECT source AS s, CAST(SUM(octet_length(encode(COALESCE(text, ''))) + 1) AS DOUBLE) AS bytes
  FROM documents GROUP BY source),
weighed AS (SELECT s, bytes, ROUND(SQRT(bytes), 6) AS weight FROM sized),
rates AS (
  SELECT s, ROUND((SELECT SUM(bytes) FROM weighed) * weight / (SELECT ROUND(SUM(weight), 6) FROM weighed) / bytes, 9) AS rate
  FROM weighed),
means AS (SELECT s, rate, GREATEST(CEIL(rate / 8.0), 1) AS parts FROM rates),
terms AS (
  SELECT s, rate, parts, CAST(UNNEST(generate_series(0, 60)) AS INTEGER) AS k FROM means),
below AS (
  SELECT s, rate, parts, k,
    SUM(exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1)) OVER (PARTITION BY s ORDER BY k) AS cdf
  FROM terms),
draws AS (
  SELECT doc_id, COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(COALESCE(text, '')) || ':' AS key, source, CAST(UNNEST(generate_series(1, CAST(parts AS BIGINT))) AS INTEGER) AS i, rate
  FROM documents JOIN means ON source IS NOT DISTINCT FROM s),
numbers AS (
  SELECT doc_id, key, source, rate, i,
    (CAST('0x' || substr(md5('17:' || key || ':' || i), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM draws),
counted AS (
  SELECT doc_id, key, n.source, n.rate, CAST(SUM((SELECT COUNT(*) FROM below b WHERE b.s IS NOT DISTINCT FROM n.source AND b.cdf < n.u AND b.k < 60)) AS INTEGER) AS mix_copies
  FROM numbers n GROUP BY doc_id, key, n.source, n.rate),
rows AS (
  SELECT doc_id, key, ROUND(rate, 6) AS mix_rate, mix_copies, CAST(UNNEST(generate_series(1, mix_copies)) AS INTEGER) AS mix_copy
  FROM counted)
SELECT d.*, r.mix_rate, r.mix_copies, r.mix_copy,
  md5('17-place:' || r.key || ':' || r.mix_copy) AS mix_key
FROM documents d JOIN rows r USING (doc_id)
"""


def crc32(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, bit by bit: DuckDB has no function for it."""
    bit = "lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), {bit})"
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}), CAST(4294967295 AS BIGINT))"


SHARDING = f"""
WITH sized AS (
  SELECT doc_id, CAST(octet_length(encode(COALESCE(text, ''))) + 1 AS BIGINT) AS size, {crc32("COALESCE(text, '')")} AS text_crc32 FROM documents),
summed AS (SELECT *, CAST(SUM(size) OVER (ORDER BY doc_id) - size AS BIGINT) AS first_byte, SUM(size) OVER () AS total FROM sized),
cut AS (SELECT *, CAST((CAST(2 * first_byte + size AS HUGEINT) * 16) // (2 * total) AS INTEGER) AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, ROW_NUMBER() OVER (PARTITION BY shard ORDER BY first_byte) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, first_byte
FROM cut
"""


def _sized(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"


def _folding(name: str, key: str, first: str) -> str:
    """Levels of a binary tree: each row holds all nodes of one level."""
    return f"""{name} AS (
  SELECT {key}, 0 AS k, nodes FROM ({first})
  UNION ALL
  SELECT {key}, k + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || COALESCE(nodes[2 * i + 2], '')))
  FROM {name} WHERE len(nodes) > 1)"""


def merkle() -> str:
    """All levels of all trees, siblings by position, and every path folded anew."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = " || ".join(map(_sized, fields))
    changed = leaf.replace("n_chars", "(n_chars + 1)")
    step = """CASE WHEN nodes[xor(pos >> k, 1) + 1] IS NULL THEN ''
      ELSE (CASE WHEN (pos >> k) & 1 = 1 THEN '<' ELSE '>' END) || nodes[xor(pos >> k, 1) + 1] END"""
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({leaf}) AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN sha256({changed}) ELSE sha256({leaf}) END AS changed,
    ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM documents),
{_folding("inner_tree", "lang", "SELECT lang, LIST(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY lang")},
subroots AS (
  SELECT lang, nodes[1] AS subroot, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM inner_tree WHERE len(nodes) = 1),
{_folding("outer_tree", "one", "SELECT 1 AS one, LIST(subroot ORDER BY pos) AS nodes FROM subroots")},
top AS (SELECT nodes[1] AS root FROM outer_tree WHERE len(nodes) = 1),
steps AS (
  SELECT doc_id, 0 AS part, k, {step} AS step
  FROM leaves JOIN inner_tree t ON t.lang IS NOT DISTINCT FROM leaves.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT doc_id, 1, k, {step}
  FROM (SELECT doc_id, s.pos FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang), outer_tree WHERE len(nodes) > 1),
paths AS (SELECT doc_id, LIST(step ORDER BY part, k) AS steps FROM steps GROUP BY doc_id),
folded AS (
  SELECT l.doc_id, leaf, subroot, root, COALESCE(steps, CAST([] AS VARCHAR[])) AS steps, changed
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN top LEFT JOIN paths p ON p.doc_id = l.doc_id)
SELECT doc_id, leaf, subroot, root,
  sha256(list_aggregate(list_prepend('', list_transform(steps, lambda s: s[2:])), 'string_agg', '')) AS proof_sha256,
  list_reduce(list_prepend(changed, steps), lambda d, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || d ELSE d || s[2:] END)) AS folded_root,
  folded_root = root AS verified
FROM folded
"""


def conversations() -> str:
    """Shortest repairs row by row: four automaton states, a cell being eight digits of cost and the audit."""

    def longer(cell: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST({cell}[1:8] AS INTEGER) + {cost} AS VARCHAR), 8, '0') || {cell}[9:] || '{letter}'"

    def least(*cells: str) -> str:
        return f"list_min([{', '.join(cells)}])"

    def into(cell: str, role: str) -> str:
        return f"CASE WHEN gone THEN NULL WHEN initial = '{role}' THEN {longer(cell, 'extra', 'K')} ELSE {longer(cell, '2 + extra', 'R')} END"

    def inserted(cells: str) -> str:
        one = longer
        w2 = least(f"{cells}[3]", *(one(f"{cells}[{j}]", "2", "I") for j in (1, 2, 4)))
        return f"[{cells}[1], {cells}[2], {w2}, {least(f'{cells}[4]', one(f'{cells}[3]', '2', 'I'), *(one(f'{cells}[{j}]', '4', 'II') for j in (1, 2)))}]"

    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    moved = f"""[{longer('w[1]', '3', 'D')},
      {least(longer('w[2]', '3', 'D'), f"CASE WHEN NOT gone AND initial = 's' THEN {longer('w[1]', 'extra', 'K')} END")},
      {least(longer('w[3]', '3', 'D'), into('w[1]', 'u'), into('w[2]', 'u'), into('w[4]', 'u'))},
      {least(longer('w[4]', '3', 'D'), into('w[3]', 'a'))}]"""
    return f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
    {crc32("COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations),
faulty AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    UNNEST(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hit WHERE fault <> 0),
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS i, COUNT(*) OVER (PARTITION BY conv_id) AS n,
    translate(text, {white}, '') AS body FROM faulty),
judged AS (
  SELECT conv_id, turn, role, text, i, n, role[1:1] AS initial, body = '' AS blank,
    body <> '' AND ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    body <> '' AND NOT duplicate AND body[-1:] NOT IN ('.', '!', '?') AS truncated,
    COALESCE(LAG(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] NOT IN ('su', 'ua', 'au'), FALSE) AS illegal
  FROM numbered),
cells AS (
  SELECT DISTINCT conv_id, n, CAST(0 AS BIGINT) AS i, [CAST('00000000' AS VARCHAR), NULL, NULL, NULL] AS v FROM judged
  UNION ALL
  SELECT conv_id, n, i, {moved} AS v FROM (
    SELECT c.conv_id, c.n, j.i, j.initial, j.blank OR j.duplicate AS gone, CAST(j.truncated AS INTEGER) AS extra, {inserted('c.v')} AS w
    FROM cells c JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id AND j.i = c.i + 1)),
done AS (
  SELECT conv_id, CAST(best[1:8] AS BIGINT) AS cost, best[9:] AS audit FROM (
    SELECT conv_id, {least('w[1]', 'w[4]')} AS best FROM (SELECT conv_id, {inserted('v')} AS w FROM cells WHERE i = n))),
letters AS (
  SELECT conv_id, audit[p:p] AS edit, p,
    length(regexp_replace(audit[:p], 'I', '', 'g')) AS i, length(regexp_replace(audit[:p], 'D', '', 'g')) AS place
  FROM (SELECT conv_id, audit, UNNEST(range(1, length(audit) + 1)) AS p FROM done)),
lines AS (
  SELECT l.conv_id, l.place, l.edit, j.initial, j.role, CASE WHEN edit = 'I' THEN '' ELSE j.text END AS text,
    MAX(CASE WHEN l.place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
  FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i AND edit <> 'I' WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, sha256(STRING_AGG(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place)) AS digest
  FROM lines GROUP BY conv_id),
counted AS (
  SELECT conv_id, CAST(COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS BIGINT) AS gaps,
    COUNT(*) FILTER (blank) AS blank, COUNT(*) FILTER (duplicate) AS duplicate,
    COUNT(*) FILTER (truncated) AS truncated, COUNT(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id)
SELECT a.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate, COALESCE(truncated, 0) AS truncated,
  COALESCE(illegal, 0) AS illegal, COALESCE(cost, 0) AS cost, COALESCE(audit, '') AS audit, COALESCE(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": EXACT_DEDUP,
        "op9_sharding": SHARDING,
        "op10_mixing": MIXING,
        "op11_merkle_manifest": merkle(),
        "op13_conversation_repair": conversations(),
    }
