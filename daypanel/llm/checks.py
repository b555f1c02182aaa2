"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

def _digits(part: int) -> str:
    """Four base-32 digits of five hexadecimal ones."""
    value = f"CAST('0x' || substr(hex, {5 * part + 1}, 5) AS BIGINT)"
    return " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0))


OP2 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, payload_bytes, {" || ".join(map(_digits, range(8)))} AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""

_LETTER_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_LETTER_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, list_slice(w, s + 1, s + least(13, len(w))) AS win
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_LETTER_WORDS} AS w FROM documents),
starts AS (SELECT r, w, unnest(range(0, len(w))) AS s FROM docs),
lengths AS (SELECT DISTINCT len(win) AS n FROM wins),
cut AS (SELECT r, s, n, list_slice(w, s + 1, s + n) AS win FROM starts, lengths WHERE s + n <= len(w)),
hits AS (SELECT r, s, n, item_id FROM cut JOIN wins USING (win)),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS pos FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN found USING (r)
"""



def _crc_table() -> str:
    """The 256 values of the checksum's table as a list: eight shifts of each byte."""
    rows = "SELECT i, i AS v FROM range(256) AS r(i)"
    for _ in range(8):
        rows = f"SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM ({rows})"
    return f"SELECT list(v ORDER BY i) AS t FROM ({rows})"


OP12 = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said FROM conversations),
own AS (SELECT conv_id, list(said ORDER BY pos) AS says FROM turns GROUP BY conv_id),
crc AS ({_crc_table()}),
heads AS (
  SELECT conv_id, says, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]))) % 6 AS h
  FROM own, crc),
convs AS (
  SELECT c.conv_id, list_concat(coalesce(b.says, [])[1:c.h], c.says[c.h + 1:]) AS says
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, says[1:d] AS path, len(says) = d AS ends FROM (SELECT conv_id, says, unnest(range(0, len(says) + 1)) AS d FROM convs)),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d > 0 THEN length(path[d].text) ELSE 0 END AS saves
  FROM prefixes GROUP BY d, path),
kids AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
leaves AS (SELECT n.d, n.path, saves, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes n LEFT JOIN kids k USING (d, path)),
sums AS (
  SELECT up AS d, path[1:up] AS path, sum(leaf) AS n_leaves, sum(saves) AS saved
  FROM (SELECT path, leaf, saves, unnest(range(0, d + 1)) AS up FROM leaves) GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (d, path) LEFT JOIN kids k USING (d, path)
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""

OP13 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

CHECKS: dict[str, str] = {"op2_warc": OP2, "op5_decontamination": OP5, "op12_prefix_trie": OP12, "op13_exact_duplicates": OP13}
