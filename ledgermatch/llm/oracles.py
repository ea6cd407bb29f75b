"""The same results in DuckDB's SQL, in forms of their own: whole trees level by level, whole paths as lists, and markup cut by patterns."""

from __future__ import annotations

from ledgermatch.llm.common import WORD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "lambda c, z: xor(c >> 1, (c & 1) * 3988292384)"
    each = f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))), {each}), 4294967295)"


def merkle(levels: int = 5, arity: int = 16) -> str:
    """Trees of up to ``arity ** levels`` leaves and as many groups."""

    def encoded(c: str) -> str:
        return f"COALESCE(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(encoded, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    parts = [
        f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE 's' || source END AS g, {leaf("text")} AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS shown FROM documents
), a0 AS (
  SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, doc_id, shown FROM docs
)"""
    ]

    def tree(t: str) -> None:
        for k in range(levels):
            parts.append(f"{t}r{k} AS (SELECT g, pos // {arity} AS run, list(h ORDER BY pos) AS hs, max(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {t}{k}) GROUP BY g, pos // {arity})")
            parts.append(f"{t}{k + 1} AS (SELECT g, run AS pos, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {t}r{k})")

    def fold(t: str, start: str, pos: str) -> None:
        """Goes up the tree t with columns f (folded so far), proof and the columns of start."""
        parts.append(f"{t}f0 AS ({start})")
        for k in range(levels):
            i = f"CAST({pos} // {arity**k} % {arity} AS BIGINT)"
            left, right = f"array_to_string(hs[1:{i}], '')", f"array_to_string(hs[{i} + 2:], '')"
            step = f"CASE WHEN n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f, CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof"
            parts.append(f"{t}f{k + 1} AS (SELECT x.* REPLACE ({step}) FROM {t}f{k} x JOIN {t}r{k} r ON x.{t}g = r.g AND x.{pos} // {arity ** (k + 1)} = r.run)")

    tree("a")
    parts.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, h, g AS source FROM a{levels})")
    tree("b")
    fold("a", "SELECT g AS ag, pos AS apos, doc_id, h AS leaf, COALESCE(shown, h) AS f, '' AS proof FROM a0", "apos")
    fold("b", f"SELECT af.*, 0 AS bg, s.pos AS bpos, s.h AS subroot, (SELECT h FROM b{levels}) AS root FROM af{levels} af JOIN b0 s ON s.source = af.ag", "bpos")
    return ", ".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM bf{levels}"


TRIE = f"""
WITH own AS (
  SELECT conv_id AS c, COALESCE(role, '') AS r, COALESCE(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL
), original AS (
  SELECT c, r, t, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, sha256(strlen(r) || ':' || r || t)) AS p FROM own
), convs AS (
  SELECT c, c - c % 20 AS b, {crc32("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM own)
), joint AS (
  SELECT convs.c, o.p, o.r, o.t FROM convs JOIN original o ON o.c = convs.b AND o.p <= convs.h
  UNION ALL SELECT convs.c, o.p + 1000000, o.r, o.t FROM convs JOIN original o ON o.c = convs.c AND o.p > convs.h
), rebuilt AS (
  SELECT convs.c, COALESCE(s, []) AS s FROM convs LEFT JOIN (SELECT c, list({{'r': r, 't': t}} ORDER BY p) AS s FROM joint GROUP BY c) USING (c)
), passed AS (
  SELECT c, len(s) AS n, d, s[1:d] AS path FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, sha256(COALESCE(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].t, '{WORD}')) END AS words
  FROM passed GROUP BY path, d
), children AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), each AS (
  SELECT nodes.*, COALESCE(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (path, d)
), sums AS (
  SELECT path[1:a] AS path, a AS d, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT path, n_children, n_convs, words, unnest(range(0, d + 1)) AS a FROM each) GROUP BY ALL
)
SELECT each.conv_id, each.d AS depth, up.conv_id AS parent_conv_id, each.n_convs, each.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, each.ends_sha256
FROM each JOIN sums USING (path, d) LEFT JOIN nodes up ON up.d = each.d - 1 AND up.path = each.path[1:each.d - 1]
"""

#: These tables' pages mark their article and use these references only.
MAIN_TEXT = r"""
WITH cut AS (
  SELECT page_id, url, unnest(list_prepend('', string_split_regex(COALESCE(regexp_extract(html, '(?s)<article>(.*)</article>', 1), ''), '</?(?:p|h1)>'))) AS b, generate_subscripts(list_prepend('', string_split_regex(COALESCE(regexp_extract(html, '(?s)<article>(.*)</article>', 1), ''), '</?(?:p|h1)>')), 1) AS i FROM pages
), plain AS (
  SELECT page_id, url, i, replace(replace(regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;', '"'), '&middot;', '·') AS b FROM cut
), lines AS (
  SELECT page_id, url, i, trim(regexp_replace(regexp_replace(replace(b, '&copy;', '©'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS b FROM plain
), texts AS (
  SELECT page_id, any_value(url) AS url, COALESCE(string_agg(b, chr(10) ORDER BY i) FILTER (WHERE b <> ''), '') AS text FROM lines GROUP BY page_id
)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""
