"""DuckDB SQL for the corpus queries that SQL can express, written from the contracts."""

from __future__ import annotations

from orderloom.llm.quality_rules import STOP_WORDS

WORD = r"[^\x20\x09-\x0D]+"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY_RULES = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM texts),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
    FROM worded, unnest(range(1, greatest(len(w) - 3, 1))) AS places(i)
),
repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, unnest(range(0, 5)) AS steps(k) GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
),
counts AS (
    SELECT
        doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
        len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_neighbours,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
    FROM worded LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
),
judged AS (
    SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS again FROM counts
)
SELECT
    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR again AS base_failed,
    failed_rules = '' AS kept, failed_rules
FROM (
    SELECT *, array_to_string(list_filter([
        CASE WHEN few THEN 'few_words' END,
        CASE WHEN again THEN 'repeated_windows' END,
        CASE WHEN 100 * word_chars NOT BETWEEN 300 * n_words AND 1200 * n_words THEN 'word_length' END,
        CASE WHEN 100 * n_symbols > 10 * n_words THEN 'symbols' END,
        CASE WHEN 100 * n_capitals > 40 * word_chars THEN 'capitals' END,
        CASE WHEN 100 * n_stop_words < 4 * greatest(n_words - 20, 0) THEN 'stop_words' END,
        CASE WHEN 100 * n_neighbours > 20 * n_words THEN 'repeated_neighbours' END,
        CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 'duplicate_lines' END
    ], lambda x: x IS NOT NULL), ',') AS failed_rules
    FROM judged
)
"""

LINE_DEDUP = r"""
WITH occurrences AS (
    SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS k, pos, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded
    FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
    )
),
firsts AS (
    SELECT line, length(line) AS n, min((k, pos)) AS place FROM occurrences WHERE worded GROUP BY line
),
long AS (SELECT * FROM firsts WHERE n >= 24),
links AS (
    SELECT a.line AS one, b.line AS two, a.place < b.place AS in_order
    FROM long a JOIN long b ON b.n BETWEEN a.n AND a.n + 2 AND (a.n < b.n OR a.line < b.line)
    WHERE levenshtein(a.line, b.line) <= 2
),
ends AS (
    SELECT one AS line, NOT in_order AS later FROM links UNION ALL SELECT two, in_order FROM links
),
notes AS (SELECT line, bool_or(later) AS near, count(*) AS links FROM ends GROUP BY line),
marked AS (
    SELECT o.*, coalesce(notes.near, FALSE) AS near, coalesce(notes.links, 0) AS links,
           worded AND (k, pos) <> firsts.place AS again
    FROM occurrences o LEFT JOIN firsts USING (line) LEFT JOIN notes USING (line)
)
SELECT
    doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT near AND NOT coalesce(again, FALSE)), '') AS text,
    count(*) AS n_lines, count(*) FILTER (NOT near AND again) AS removed_exact,
    count(*) FILTER (near) AS removed_near, sum(links)::BIGINT AS n_links
FROM marked GROUP BY doc_id
"""

TOPK = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, row_number() OVER best AS rank, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id
WHERE q.vec_id % 50 = 0
WINDOW best AS (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)
QUALIFY rank <= 5
"""

WARC = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
named AS (
    SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY h) AS first, array_to_string(list_transform(
        range(0, 32),
        lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 1 + 5 * (j // 4), 5))::BIGINT >> (15 - 5 * (j % 4))) & 31), 1)
    ), '') AS payload_digest
    FROM hashed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM named
"""

# Every order is played through; the Shapley sums come from the steps and not from potentials.
FILTER_AUDIT = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w FROM texts),
tested AS (
    SELECT
        doc_id, part,
        CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) THEN 16 ELSE 0 END AS mask
    FROM worded
),
marks AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id
),
cells AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t
    FROM tested LEFT JOIN marks USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
),
steps AS (
    SELECT
        filter_order, step, filter_order[step] AS letter, 1 << (ascii(filter_order[step]) - 65) AS own,
        coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::int AS before
    FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step)
),
played AS (
    SELECT
        part, filter_order, step, letter,
        coalesce(sum(n) FILTER (mask & (before | own) = 0), 0) AS kept,
        coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS removed,
        coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0) AS redundant,
        coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
        coalesce(sum(g) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS good_lost,
        coalesce(sum(t) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS toxic_lost
    FROM cells, steps GROUP BY ALL
)
SELECT
    part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
    unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::bigint AS shapley
FROM played
"""

# A node is the list of its turns; the CRC is worked out bit by bit.
CONVERSATION_TRIE = r"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc(c, k, v) AS (
    SELECT c, 0, 4294967295::bigint FROM ids
    UNION ALL
    SELECT c, k + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) FROM (
        SELECT c, k, xor(v, CASE WHEN k % 8 = 0 THEN ascii((c::varchar)[k // 8 + 1]) ELSE 0 END::bigint) AS x
        FROM crc WHERE k < 8 * length(c::varchar)
    )
),
starts AS (SELECT c, (xor(v, 4294967295) % 6)::int AS h FROM crc WHERE k = 8 * length(c::varchar)),
turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (SELECT c, list({'role': role, 'text': text} ORDER BY place) AS l FROM turns GROUP BY c),
rebuilt AS (
    SELECT s.c, list_concat(coalesce(b.l, [])[1:s.h], o.l[s.h + 1:]) AS l
    FROM starts s JOIN lists o ON o.c = s.c LEFT JOIN lists b ON b.c = s.c - s.c % 100
),
steps AS (SELECT c, l, unnest(range(0, len(l) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT l[1:depth] AS path, depth, min(c) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (len(l) = depth), '') AS ends,
        coalesce((count(*) - 1) * length(any_value(l[depth].text)), 0) AS saved
    FROM steps GROUP BY l[1:depth], depth
),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
subtrees AS (
    SELECT path[1:d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM whole, unnest(range(0, depth + 1)) AS up(d) GROUP BY 1
)
SELECT
    w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
    s.saved_tokens::bigint AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM whole w JOIN subtrees s ON s.path = w.path
LEFT JOIN whole p ON w.depth > 0 AND p.path = w.path[1:w.depth - 1]
"""

NEAR_VECTORS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::double[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
links AS (
    SELECT a.vec_id AS one, b.vec_id AS two FROM vectors a JOIN vectors b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
),
reach(one, two) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.one, l.two FROM reach r JOIN links l ON l.one = r.two
),
named AS (SELECT one AS vec_id, min(two) AS component_id FROM reach GROUP BY one),
counted AS (SELECT one AS vec_id, count(*) AS n_links FROM links GROUP BY one)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""

SQL = {
    "op11_embedding_near_dedup": NEAR_VECTORS,
    "op13_conversation_trie": CONVERSATION_TRIE,
    "op12_filter_audit": FILTER_AUDIT,
    "op2_line_dedup": LINE_DEDUP,
    "op3_quality_rules": QUALITY_RULES,
    "op5_topk_search": TOPK,
    "op9_warc": WARC,
}
