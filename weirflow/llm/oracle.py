"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from weirflow.llm.lines import LEAST, RATIO
from weirflow.llm.urls import LEAST as PRIOR_LEAST
from weirflow.llm.urls import LIMIT, MOST, SECOND_LEVEL, Z

LINE_DEDUP = f"""
WITH texts AS (
    SELECT DISTINCT source, text FROM documents WHERE source IS NOT NULL
), lines AS (
    SELECT source, unnest(list_distinct(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))) AS line FROM texts WHERE text IS NOT NULL
), totals AS (
    SELECT source, count(*) AS pages FROM texts GROUP BY source
), counts AS (
    SELECT source, line, count(*) AS n FROM lines GROUP BY source, line
), often AS (
    SELECT source, list(line) AS gone FROM counts JOIN totals USING (source)
    WHERE n >= {LEAST} AND n > CAST({RATIO} AS DOUBLE) * pages GROUP BY source
), cleaned AS (
    SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, CASE WHEN gone IS NULL THEN text
        ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(gone, x)), chr(10)) END AS text
    FROM documents LEFT JOIN often USING (source)
)
SELECT doc_id, text, n_lines, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS n_kept FROM cleaned
"""


def _shrunk(stats: str, parents: str, parent: str) -> str:
    """The members of a level with the mean of their posterior under the prior of their parent."""
    noise = "(q * (1 - q))"
    extra = f"((ss - members * {noise}) / total)"
    weight = f"CASE WHEN total = 0 THEN above WHEN {extra} > 0 THEN least(greatest({noise} / {extra} - 1, {PRIOR_LEAST}), {MOST}) ELSE {MOST} END"
    return f"""(
    WITH j AS (SELECT s.*, p.mean AS p, p.m AS above FROM {stats} s JOIN {parents} p USING ({parent})),
    spread AS (
        SELECT {parent}, sum(n * pow(bad / n - p, 2)) FILTER (n > 0) AS ss, sum(n) AS total, count(*) FILTER (n > 0) AS members,
            any_value(p) AS q, any_value(above) AS above FROM j GROUP BY {parent}
    ), w AS (SELECT {parent}, CAST({weight} AS DOUBLE) AS m FROM spread)
    SELECT j.* EXCLUDE (p, above), m, (bad + m * p) / (n + m) AS mean FROM j JOIN w USING ({parent}))"""


URL_FILTERS = f"""
WITH rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), known AS (
    SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR coalesce(toxic, 0) = 1 THEN 1 WHEN quality IS NULL THEN NULL ELSE 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), counted AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name
    FROM u LEFT JOIN known USING (page_id) WHERE host <> '' GROUP BY host
), parts AS (
    SELECT *, string_split(name, '.') AS parts, regexp_full_match(name, '([0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}|\\[.*\\])') AS address FROM counted
), lengths AS (
    SELECT *, CASE WHEN len(parts) > 2 AND list_contains({list(SECOND_LEVEL)}, parts[-2]) AND length(parts[-1]) = 2 THEN 2 ELSE 1 END AS last FROM parts
), hosts AS (
    SELECT host, n, bad, CASE WHEN address THEN name ELSE array_to_string(parts[greatest(len(parts) - last, 1):], '.') END AS domain,
        CASE WHEN address THEN name ELSE array_to_string(parts[greatest(len(parts) - last + 1, 1):], '.') END AS suffix FROM lengths
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, 0 AS top, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix
), tops AS (SELECT top, (sum(bad) + 1) / (sum(n) + 2) AS mean, CAST({MOST} AS DOUBLE) AS m FROM suffixes GROUP BY top HAVING sum(n) > 0
), s AS (SELECT * FROM {_shrunk("suffixes", "tops", "top")}
), d AS (SELECT * FROM {_shrunk("domains", "s", "suffix")}
), h AS (SELECT * FROM {_shrunk("hosts", "d", "domain")}
), blocked AS (
    SELECT host, true AS blocked FROM h WHERE mean - {Z} * sqrt(mean * (1 - mean) / (n + m + 1)) > {LIMIT}
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN blocked USING (host)
"""



def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters."""
    bits = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, {})"
    chars = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    step = bits.format("xor(crc, ch)")
    return f"xor(4294967295, list_reduce({chars}, lambda crc, ch: {step}, CAST(4294967295 AS BIGINT)))"


def _sized(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_sized, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


MERKLE_MANIFEST = f"""
WITH RECURSIVE now AS (
    SELECT *, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents
), hashed AS (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf("text")} AS leaf, {_leaf("changed")} AS folded FROM now
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), nodes AS (
    SELECT tree, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY tree, level, place // 3
), subroots AS (
    SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM nodes WHERE n = 1
), top AS (
    SELECT 0 AS level, place, subroot AS digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3 FROM top WHERE n > 1 GROUP BY level, place // 3
), spots AS (
    SELECT l.tree, l.place AS leaf_place, n.level, n.place // 3 AS parent, n.place FROM leaves l JOIN nodes n ON n.tree = l.tree AND n.n > 1
        AND n.place = l.place // CAST(pow(3, n.level) AS BIGINT)
    UNION ALL
    SELECT l.tree, l.place, 1000 + t.level, t.place // 3, t.place FROM leaves l JOIN subroots s ON s.tree = l.tree
        JOIN top t ON t.n > 1 AND t.place = s.place // CAST(pow(3, t.level) AS BIGINT)
), others AS (
    SELECT tree, level, place, digest FROM nodes UNION ALL SELECT s.tree, 1000 + t.level, t.place, t.digest FROM top t CROSS JOIN subroots s
), ways AS (
    SELECT s.tree, s.leaf_place, s.level, coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < s.place), '') AS l,
        coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > s.place), '') AS r
    FROM spots s JOIN others o ON o.tree = s.tree AND o.level = s.level AND o.place // 3 = s.parent GROUP BY ALL
), steps AS (
    SELECT *, row_number() OVER (PARTITION BY tree, leaf_place ORDER BY level) AS k FROM ways
), folds AS (
    SELECT tree, place, 1 AS k, folded FROM leaves
    UNION ALL
    SELECT f.tree, f.place, f.k + 1, sha256(s.l || f.folded || s.r) FROM folds f JOIN steps s ON s.tree = f.tree AND s.leaf_place = f.place AND s.k = f.k
), ends AS (SELECT tree, place, arg_max(folded, k) AS folded_root FROM folds GROUP BY tree, place
), proofs AS (SELECT tree, leaf_place AS place, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM steps GROUP BY tree, leaf_place)
SELECT doc_id, leaf, subroot, digest AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = digest AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends ON ends.tree = leaves.tree AND ends.place = leaves.place
    LEFT JOIN proofs ON proofs.tree = leaves.tree AND proofs.place = leaves.place CROSS JOIN (SELECT digest FROM top WHERE n = 1) root
"""

PREFIX_TRIE = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), m AS (
    SELECT conv_id, turn, role, length(text) AS chars, sha256(octet_length(encode(role)) || ':' || role || text) AS mark FROM t
), o AS (
    SELECT conv_id, mark, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, mark) - 1 AS place FROM m
), own AS (
    SELECT conv_id, count(*) AS n, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h, conv_id - conv_id % 100 AS base FROM o GROUP BY conv_id
), c AS (
    SELECT own.*, least(own.h, coalesce(b.n, 0)) AS nb FROM own LEFT JOIN own b ON b.conv_id = own.base
), r AS (
    SELECT c.conv_id, o.place, o.mark, o.chars FROM c JOIN o ON o.conv_id = c.base AND o.place < c.h
    UNION ALL SELECT c.conv_id, o.place - c.h + c.nb, o.mark, o.chars FROM c JOIN o ON o.conv_id = c.conv_id AND o.place >= c.h
), p AS (
    SELECT conv_id, place + 1 AS depth, chars, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix FROM r
    UNION ALL SELECT conv_id, 0, 0, '' FROM c
), ends AS (
    SELECT depth, prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM p) WHERE depth = last GROUP BY depth, prefix
), n AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM p GROUP BY depth, prefix
), spot AS (
    SELECT p.conv_id AS member, p.depth, n.conv_id FROM p JOIN n ON n.depth = p.depth AND n.prefix = p.prefix
), linked AS (
    SELECT n.*, s.conv_id AS parent_conv_id FROM n LEFT JOIN spot s ON s.member = n.conv_id AND s.depth = n.depth - 1
), kids AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE parent_conv_id IS NOT NULL GROUP BY ALL
), full_nodes AS (
    SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids ON kids.conv_id = linked.conv_id AND kids.depth = linked.depth
), totals AS (
    SELECT s.conv_id, s.depth, count(*) FILTER (x.n_children = 0) AS n_leaves, CAST(sum((x.n_convs - 1) * x.chars) AS BIGINT) AS saved_tokens
    FROM full_nodes x JOIN spot s ON s.member = x.conv_id AND s.depth <= x.depth GROUP BY s.conv_id, s.depth
)
SELECT f.conv_id, f.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_nodes f JOIN totals USING (conv_id, depth) LEFT JOIN ends ON ends.depth = f.depth AND ends.prefix = f.prefix
"""

ORACLE = {"op7_line_dedup": LINE_DEDUP, "op8_url_filters": URL_FILTERS, "op12_conversation_prefix_trie": PREFIX_TRIE, "op13_merkle_dataset_manifest": MERKLE_MANIFEST}
