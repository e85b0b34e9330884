"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from rillweave.llm.line_dedup import MIN_PAGES, RATIO
from rillweave.llm.quality_rules import MEASURES, QualityPolicy

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Smallest member of the component of each node of ``links`` (u, v), both directions given.
_REACH = """
reach(node, other) AS (
    SELECT node, node FROM nodes
    UNION
    SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other
)
"""


def _near_vectors() -> str:
    return f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id u, b.vec_id v FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
),
nodes AS (SELECT vec_id node FROM embeddings),
{_REACH},
root AS (SELECT node, min(other) component_id FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n, 0)::BIGINT n_links, component_id, e.vec_id = component_id kept
FROM embeddings e JOIN root ON node = e.vec_id
LEFT JOIN (SELECT u, count(*) n FROM links GROUP BY u) ON u = e.vec_id
"""


def _line_dedup() -> str:
    blanks = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH parts AS (
    SELECT doc_id, source, text, string_split(text, chr(10)) lines FROM documents
),
pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
totals AS (SELECT source, count(*) pages FROM pages GROUP BY source),
bad AS (
    SELECT l.source, line FROM (
        SELECT source, text, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda l: trim(l, {blanks})))) line
        FROM pages
    ) l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
    WHERE line <> '' GROUP BY l.source, line HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * any_value(pages)
),
per_site AS (SELECT source, list(line) bad_lines FROM bad GROUP BY source),
kept AS (
    SELECT doc_id, p.source, text, lines,
        list_filter(lines, lambda l: bad_lines IS NULL OR NOT list_contains(bad_lines, trim(l, {blanks}))) rest
    FROM parts p LEFT JOIN per_site s ON p.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, coalesce(len(lines), 0)::BIGINT n_lines, coalesce(len(lines) - len(rest), 0)::BIGINT n_dropped,
    strlen(array_to_string(rest, chr(10)))::BIGINT clean_bytes, md5(array_to_string(rest, chr(10))) clean_md5
FROM kept
"""


def _ngram_join() -> str:
    return f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) END s FROM worded
),
grams AS (SELECT doc_id, len(s) n, unnest(s) g FROM sets),
links AS (
    SELECT a.doc_id u, b.doc_id v FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
),
nodes AS (SELECT doc_id node FROM documents),
{_REACH},
root AS (SELECT node, min(other) component_id FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT n_shingles, component_id FROM sets JOIN root ON node = doc_id
"""


def _quality_rules() -> str:
    policy = QualityPolicy()
    values = {m: v.replace(" div ", " // ").replace("if(", "if(") for m, (v, _) in MEASURES.items()}
    bins = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' measure, {v} bin FROM measured WHERE NOT base_failed" for m, v in values.items()
    )

    def quartiles(keys: str) -> str:
        join = " AND ".join(f"c.{k} IS NOT DISTINCT FROM t.{k}" for k in keys.split(", "))
        return f"""SELECT {', '.join('c.' + k for k in keys.split(', '))},
            min(bin) FILTER (4 * upto >= total) q1, min(bin) FILTER (4 * upto >= 3 * total) q3, max(total) total
        FROM (SELECT {keys}, bin, sum(count(*)) OVER (PARTITION BY {keys} ORDER BY bin) upto FROM bins GROUP BY {keys}, bin) c
        JOIN (SELECT {keys}, count(*) total FROM bins GROUP BY {keys}) t ON {join}
        GROUP BY {', '.join('c.' + k for k in keys.split(', '))}"""

    few, few_l = f"c.total < {policy.min_cell}", f"l.total < {policy.min_cell}"
    q1, q3 = (f"(CASE WHEN {few} AND {few_l} THEN e.{q} WHEN {few} THEN l.{q} ELSE c.{q} END)" for q in ("q1", "q3"))
    slack = "CASE c.measure " + " ".join(f"WHEN '{m}' THEN {s}" for m, (_, s) in MEASURES.items()) + " END"
    above = " OR ".join(f"measure = '{m}' AND {v} > cut" for m, v in values.items())
    return f"""
WITH words AS (
    SELECT doc_id, lang, source, coalesce(text, '') text, {_WORDS} w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) l
    FROM documents
),
spans AS (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g) n FROM (
        SELECT doc_id, unnest(range(1, len(w) - 1)) pos, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])) g
        FROM words WHERE len(w) >= 3
    )
),
repeats AS (
    SELECT doc_id, count(DISTINCT pos + k) n FROM spans, (SELECT unnest([0, 1, 2]) k) WHERE n > 1 GROUP BY doc_id
),
measured AS (
    SELECT *, n_words < {policy.min_words} OR 100 * n_repeat_words > {policy.max_repeat_percent} * n_words base_failed
    FROM (
        SELECT doc_id, lang, source, len(w)::BIGINT n_words, length(array_to_string(w, ''))::BIGINT word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT n_symbols,
            len(regexp_extract_all(text, '[A-Z]'))::BIGINT n_upper,
            len(l)::BIGINT n_lines, (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines,
            coalesce(r.n, 0)::BIGINT n_repeat_words
        FROM words LEFT JOIN repeats r USING (doc_id)
    )
),
bins AS ({bins}),
cell AS ({quartiles("lang, source, measure")}),
language AS ({quartiles("lang, measure")}),
everything AS ({quartiles("measure")}),
cuts AS (
    SELECT c.lang, c.source, c.measure, {q3} + {policy.spread} * ({q3} - {q1}) + {slack} cut
    FROM cell c JOIN language l ON c.lang IS NOT DISTINCT FROM l.lang AND c.measure = l.measure
    JOIN everything e ON c.measure = e.measure
)
SELECT doc_id, lang, source, word_chars, n_symbols, n_upper, n_words, n_lines, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT EXISTS (
        SELECT 1 FROM cuts WHERE cuts.lang IS NOT DISTINCT FROM m.lang AND cuts.source IS NOT DISTINCT FROM m.source
        AND ({above})
    ) kept
FROM measured m
"""


def _crc32(text: str) -> str:
    """crc32 of a short text of ASCII characters, bit by bit."""
    bits = "[1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]"
    step = f"list_reduce(list_prepend(xor(a, b), {bits}), lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1)))"
    letters = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda a, b: {step}), 4294967295::BIGINT)"


def _decontamination() -> str:
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () r, doc_id, {words} w FROM documents),
items AS (SELECT item_id, {words} w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, len(w[i : i + 9]) width, array_to_string(w[i : i + 9], ' ') g
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(i) WHERE len(w) > 0
),
widths AS (SELECT DISTINCT width FROM windows),
found AS (
    SELECT r, i, d.width, item_id FROM (
        SELECT r, i, width, array_to_string(w[i : i + width - 1], ' ') g
        FROM docs, widths, unnest(range(1, len(w) - width + 2)) u(i)
    ) d JOIN windows x ON d.width = x.width AND d.g = x.g
),
hit AS (SELECT r, count(DISTINCT p) n FROM found, unnest(range(i, i + width)) u(p) GROUP BY r),
named AS (
    SELECT r, count(*) n, string_agg(item, ',' ORDER BY item) ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(h.n, 0)::BIGINT n_hit, coalesce(m.n, 0)::BIGINT n_items,
    sha256(coalesce(ids, '')) items_sha256, h.n IS NOT NULL contaminated
FROM docs d LEFT JOIN hit h ON h.r = d.r LEFT JOIN named m ON m.r = d.r
"""


def _conversation_trie() -> str:
    return f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) p,
        {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} t
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id c, list(t ORDER BY p) t FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT o.c, list_concat(coalesce(b.t, [])[: h], o.t[h + 1 :]) t
    FROM (SELECT c, t, {_crc32("c::VARCHAR")} % 9 h FROM own) o LEFT JOIN own b ON b.c = o.c - o.c % 5
),
paths AS (
    SELECT c, d, t[: d] path, d = len(t) ends, CASE WHEN d = 0 THEN 0 ELSE strlen(t[d].text) END bytes
    FROM rebuilt, unnest(range(0, len(t) + 1)) u(d)
),
nodes AS (
    SELECT d, path, min(c) c, count(*) n, any_value(bytes) bytes,
        string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c) ids
    FROM paths GROUP BY d, path
),
kids AS (SELECT d - 1 d, path[: d - 1] path, count(*) n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (
    SELECT n.*, coalesce(k.n, 0) n_children FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.path = n.path
),
below AS (
    SELECT a.d, a.path, count(*) FILTER (b.n_children = 0) n_leaves, sum((b.n - 1) * b.bytes) saved
    FROM counted a JOIN counted b ON b.d >= a.d AND b.path[: a.d] = a.path GROUP BY a.d, a.path
)
SELECT n.c conv_id, n.d depth, p.c parent_conv_id, n.n n_convs, n.n_children, n_leaves::BIGINT n_leaves,
    saved::BIGINT saved_tokens, sha256(coalesce(n.ids, '')) ends_sha256
FROM counted n JOIN below b ON b.d = n.d AND b.path = n.path
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[: n.d - 1]
"""


def _merkle_manifest() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    tampered = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    climb = """
    SELECT {0}, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i))
    FROM {1} WHERE n > 1 GROUP BY {0}, level, i // 3, n
"""
    # Siblings of each node, in order, to its left and to its right.
    beside = """
    SELECT a.*, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') l,
        coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') r
    FROM {1} a LEFT JOIN {1} b ON {0} AND a.level = b.level AND a.i // 3 = b.i // 3 AND a.i <> b.i
    WHERE a.n > 1 GROUP BY ALL
"""
    return f"""
WITH RECURSIVE leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 i, count(*) OVER (PARTITION BY source) n
    FROM (SELECT doc_id, source, {leaf("text")} leaf, {leaf(tampered)} tampered FROM documents)
),
numbered AS (SELECT l.*, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 tree FROM leaves l),
inner_nodes(tree, level, i, n, digest) AS (
    SELECT tree, 0::BIGINT, i, n, leaf FROM numbered UNION ALL {climb.format("tree", "inner_nodes")}
),
subroots AS (SELECT tree i, level height, digest FROM inner_nodes WHERE n = 1),
top_nodes(k, level, i, n, digest) AS (
    SELECT 0, 0::BIGINT, i, (SELECT count(*) FROM subroots), digest FROM subroots UNION ALL {climb.format("k", "top_nodes")}
),
inner_beside AS ({beside.format("a.tree = b.tree", "inner_nodes")}),
top_beside AS ({beside.format("a.k = b.k", "top_nodes")}),
steps AS (
    SELECT doc_id, source, x.i, b.level, l, r FROM numbered x JOIN inner_beside b
    ON b.tree = x.tree AND b.i = x.i // CAST(pow(3, b.level) AS BIGINT)
    UNION ALL
    SELECT doc_id, source, x.i, 1000 + b.level, l, r FROM numbered x JOIN top_beside b ON b.i = x.tree // CAST(pow(3, b.level) AS BIGINT)
),
proofs AS (
    SELECT source, i, list([l, r] ORDER BY level) path FROM steps GROUP BY source, i
),
folded AS (
    SELECT x.doc_id, x.leaf, s.digest subroot, (SELECT digest FROM top_nodes WHERE n = 1) root,
        coalesce(path, []) path, tampered
    FROM numbered x JOIN subroots s ON s.i = x.tree
    LEFT JOIN proofs p ON p.i = x.i AND p.source IS NOT DISTINCT FROM x.source
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: p[1] || p[2]), '')) proof_sha256,
    list_reduce(list_prepend([tampered], path), lambda d, p: [sha256(p[1] || d[1] || p[2])])[1] folded_root,
    folded_root = root verified
FROM folded
"""


ORACLES = {
    "op2_cover_tree": _near_vectors(),
    "op6_line_dedup": _line_dedup(),
    "op8_ngram_join": _ngram_join(),
    "op10_quality_rules": _quality_rules(),
    "op11_decontamination": _decontamination(),
    "op12_conversation_trie": _conversation_trie(),
    "op13_merkle_manifest": _merkle_manifest(),
}
