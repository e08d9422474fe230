"""DuckDB SQL for the operators that SQL can express, written from their contracts.

The others learn a model or use a tokenizer; tests hold them against plain Python.
"""

WORD = r"[^\x20\x09-\x0D]+"
LEAF = r"[^\n.!?]{1,200}[.!?]*\n*|[.!?]+\n*|\n+"


def _tree(text: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all({text}, '{LEAF}'), lambda x:
        left(sha256(x), 16) || CASE WHEN NOT ends_with(x, chr(10)) THEN ' '
            WHEN left(sha256(x), 1) IN ('0', '1') THEN ';' ELSE ',' END), '')"""


def _root(tree: str) -> str:
    return f"""sha256(array_to_string(list_transform(string_split({tree}, ';'), lambda s:
        sha256(array_to_string(list_transform(string_split(s, ','), lambda p: sha256(p)), ''))), ''))"""


def _leaves(tree: str) -> str:
    return (
        f"list_distinct(list_filter(regexp_split_to_array({tree}, '[ ,;]'), lambda x: x <> ''))"
    )


def _sections(tree: str) -> str:
    return f"list_distinct(list_filter(string_split({tree}, ';'), lambda x: x <> ''))"


def _likeness(one: str, other: str) -> str:
    a, b = _leaves(f"{one}_tree"), _leaves(f"{other}_tree")
    return f"""CASE WHEN {one}_root = {other}_root THEN 1.0::DOUBLE
        ELSE 2 * len(list_intersect({a}, {b}))::DOUBLE / greatest(len({a}) + len({b}), 1) END"""


def _opened(one: str, other: str) -> str:
    """Paragraphs of the sections that the other tree does not have."""
    return f"""list_filter(string_split(array_to_string(list_filter({_sections(one)}, lambda x:
        NOT list_contains({_sections(other)}, x)), ','), ','), lambda x: x <> '')"""


FINGERPRINTS = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
        row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS n
    FROM documents),
n AS (
    SELECT doc_id, n, text,
        coalesce(lead(text) OVER (ORDER BY n), first_value(text) OVER (ORDER BY n)) AS next_text
    FROM d),
e AS (
    SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited
    FROM n),
t AS (
    SELECT *, {_tree("text")} AS own_tree, {_tree("edited")} AS edited_tree, {_tree("next_text")} AS next_tree
    FROM e),
r AS (
    SELECT *, {_root("own_tree")} AS own_root, {_root("edited_tree")} AS edited_root,
        {_root("next_tree")} AS next_root
    FROM t)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
    own_root || ':' || own_tree AS fingerprint, edited_root || ':' || edited_tree AS edited_fingerprint,
    {_likeness("own", "edited")} AS near_edited, {_likeness("own", "next")} AS near_next,
    len(list_filter({_sections("edited_tree")}, lambda x:
        NOT list_contains({_sections("own_tree")}, x)))::BIGINT AS changed_sections,
    len(list_distinct(list_filter({_opened("edited_tree", "own_tree")}, lambda x:
        NOT list_contains({_opened("own_tree", "edited_tree")}, x))))::BIGINT AS changed_paragraphs
FROM r
"""

MIXING = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
        len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
        row_number() OVER (ORDER BY source NULLS LAST) AS source_no
    FROM d GROUP BY source),
l AS (
    SELECT *, ((sum(source_size) OVER () - sum(most) OVER rising + most)::BIGINT)::DOUBLE
        / ((sum(weight) OVER () - sum(weight) OVER rising + weight)::BIGINT)::DOUBLE AS level
    FROM s WINDOW rising AS (ORDER BY most::DOUBLE / weight, source_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (
    SELECT source, source_no, source_size, least(most::DOUBLE, max(level) OVER () * weight) AS target
    FROM l),
p AS (
    SELECT d.r, d.source, d.doc_id, d.size, g.source_size, g.target, g.source_no,
        (sum(size) OVER (PARTITION BY d.source
            ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(d.text)), d.r
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
n AS (
    SELECT source_no, source_size, floor(target)::BIGINT AS quota, (source_size + 511) // 512 AS blocks,
        floor(target)::BIGINT // source_size * ((source_size + 511) // 512)
            + (floor(target)::BIGINT % source_size + 511) // 512 AS slots
    FROM g WHERE source_size > 0),
a AS (
    SELECT *, (sum(slots) OVER ())::BIGINT AS total, floor((sum(slots) OVER (ORDER BY source_no))::BIGINT::DOUBLE
        / (sum(slots) OVER ())::BIGINT::DOUBLE * 4294967296)::BIGINT AS arc_end
    FROM n WHERE slots > 0),
points AS (
    SELECT slot, ((slot::HUGEINT * 2654435769) % 4294967296)::BIGINT AS point
    FROM (SELECT unnest(range((SELECT coalesce(max(total), 0) FROM a))) AS slot)),
owned AS (
    SELECT slot, coalesce((SELECT min(source_no) FROM a WHERE arc_end > point), (SELECT max(source_no) FROM a)) AS source_no
    FROM points),
ranked AS (SELECT slot, source_no, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS k FROM owned),
given AS (SELECT source_no, count(*) AS given FROM ranked GROUP BY source_no),
used AS (
    SELECT source_no, slot, k FROM ranked UNION ALL
    SELECT source_no, total + k, k FROM (
        SELECT a.source_no, total, unnest(range(coalesce(given, 0), slots)) AS k
        FROM a LEFT JOIN given ON given.source_no = a.source_no)),
schedule AS (
    SELECT used.source_no, slot, k % blocks AS block,
        least(512, source_size - (k % blocks) * 512, quota - (k // blocks * source_size + (k % blocks) * 512)) AS words
    FROM used JOIN a ON a.source_no = used.source_no WHERE k < slots),
parts AS (
    SELECT r, source_no, start, size, unnest(range(start // 512, (start + size - 1) // 512 + 1)) AS block
    FROM p WHERE size > 0),
taken AS (
    SELECT r, sum(w)::BIGINT AS taken, min(slot)::BIGINT AS first_slot, count(*)::BIGINT AS slots,
        sum(slot)::BIGINT AS slot_sum
    FROM (SELECT r, slot, least(least(start + size, (parts.block + 1) * 512) - parts.block * 512, words)
            - (greatest(start, parts.block * 512) - parts.block * 512) AS w
        FROM parts JOIN schedule s ON s.source_no = parts.source_no AND s.block = parts.block)
    WHERE w > 0 GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, coalesce(slots, 0) AS slots,
    coalesce(slot_sum, 0) AS slot_sum
FROM p LEFT JOIN taken ON taken.r = p.r
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{WORD}') AS words
    FROM documents),
s AS (
    SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5
        THEN [array_to_string(words, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3),
            lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
    FROM w),
k AS (
    SELECT *, CASE WHEN len(shingles) = 0 THEN NULL ELSE sha256(array_to_string(shingles, chr(10))) END AS key
    FROM s),
c AS (
    SELECT key, min(r) AS r, min(doc_id) AS first_id, any_value(shingles) AS shingles
    FROM k WHERE key IS NOT NULL GROUP BY key),
u AS (SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM c),
e AS (
    SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.shingle = b.shingle AND a.r < b.r
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(r, beside) AS (
    SELECT r, r FROM c
    UNION SELECT reach.r, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.beside),
m AS (
    SELECT c.key, min(o.first_id) AS component_id
    FROM c JOIN reach ON reach.r = c.r JOIN c o ON o.r = reach.beside GROUP BY c.key)
SELECT k.doc_id, len(k.shingles)::BIGINT AS n_shingles,
    CASE WHEN k.key IS NULL THEN k.doc_id ELSE m.component_id END AS component_id,
    k.doc_id IS NOT DISTINCT FROM CASE WHEN k.key IS NULL THEN k.doc_id ELSE m.component_id END AS kept
FROM k LEFT JOIN m ON k.key = m.key
"""

CONTROL = r"<\|im_start\|>|<\|im_end\|>|</?s>|\[/?INST\]|<</?SYS>>"


def _escaped_length(column: str) -> str:
    return (
        f"(length(replace({column}, '\\', '\\\\')) + len(regexp_extract_all({column}, '{CONTROL}')))"
    )


CHATS = f"""
WITH t AS (
    SELECT conv_id, turn, role AS given_role, text AS given_text,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
            (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), ''
        ORDER BY turn NULLS FIRST, given_role NULLS FIRST, given_text NULLS FIRST)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, given_text NULLS FIRST)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<|im_start|>') + {_escaped_length("role")} + length(role) - length(replace(role, chr(10), ''))
        + 1 + {_escaped_length("text")} + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

# ---- centroid clustering: the rounds are spelled out one after another


def _clusters(clusters: int, rounds: int, seed: str, size: int) -> str:
    steps = []
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT r, arg_min(cluster, (distance, cluster)) AS cluster FROM (
        SELECT v.r, c.cluster, list_sum(list_transform(range(1, {size + 1}),
            lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS distance
        FROM v CROSS JOIN c{i} c) GROUP BY r),
m{i} AS MATERIALIZED (
    SELECT cluster, list(middle ORDER BY i) AS x FROM (
        SELECT a.cluster, i, (sum(v.x[i]) - ((sum(v.x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS middle
        FROM a{i} a JOIN v ON v.r = a.r CROSS JOIN range(1, {size + 1}) AS t(i) GROUP BY a.cluster, i)
    GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.cluster),""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS x
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS cluster, x
    FROM v QUALIFY cluster < {clusters}),
{"".join(steps)}
f AS MATERIALIZED (
    SELECT v.r, v.vec_id, c.cluster, list_sum(list_transform(range(1, {size + 1}),
        lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS distance, c.x
    FROM v CROSS JOIN c{rounds} c
    QUALIFY row_number() OVER (PARTITION BY v.r ORDER BY distance, c.cluster) = 1)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
    (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(x, ',')) AS centroid_sha256
FROM f
"""


CLUSTERS = _clusters(8, 10, "3", 64)

# ---- importance sample: the CRC of distinct words, byte by byte, with its table made by the rule

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

IMPORTANCE = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{LETTERS}') AS words FROM documents),
b AS MATERIALIZED (SELECT unnest(regexp_extract_all({LOWER}, '{LETTERS}')) AS word FROM benchmark),
o AS MATERIALIZED (SELECT r, unnest(words) AS word FROM d),
tab AS MATERIALIZED (
    SELECT list(list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
    FROM range(256) AS x(i)),
h AS (SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM o UNION SELECT word FROM b)),
w AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(digits) // 2),
        lambda i: 16 * (instr('0123456789ABCDEF', digits[2 * i + 1]) - 1) + instr('0123456789ABCDEF', digits[2 * i + 2]) - 1)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM h CROSS JOIN tab),
own AS (SELECT bucket, count(*) AS n FROM o JOIN w ON o.word = w.word GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS n FROM b JOIN w ON b.word = w.word GROUP BY bucket),
g AS MATERIALIZED (
    SELECT k.bucket, floor(1000 * ln(
        ((coalesce(wanted.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM o) + 10000)::DOUBLE)
        / ((coalesce(own.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM (SELECT DISTINCT bucket FROM w) k
    LEFT JOIN own ON own.bucket = k.bucket LEFT JOIN wanted ON wanted.bucket = k.bucket),
weights AS (
    SELECT r, sum(gain)::BIGINT AS total FROM o JOIN w ON o.word = w.word JOIN g ON g.bucket = w.bucket GROUP BY r),
s AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_features,
        CASE WHEN total IS NULL THEN 0
            ELSE (total - ((total % len(words)) + len(words)) % len(words)) // len(words) END::BIGINT AS weight,
        ('0x' || left(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 8))::BIGINT AS h
    FROM d LEFT JOIN weights ON weights.r = d.r),
p AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE))))::BIGINT AS score FROM s),
k AS (
    SELECT *, n_features >= 20 AS can, row_number() OVER (
        PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place
    FROM p)
SELECT doc_id, n_features, weight, score,
    CASE WHEN can AND place <= (SELECT count(*) FROM p WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM k
"""

ORACLES: dict[str, str] = {
    "op1_fingerprints": FINGERPRINTS,
    "op2_mixing": MIXING,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op5_chat_tree": CHATS,
    "op11_centroid_clusters": CLUSTERS,
    "op12_importance_sample": IMPORTANCE,
}
