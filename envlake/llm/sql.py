"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .text import ALNUM_WORD, BLACK_WORD

_ALNUM = ALNUM_WORD.replace("\\x00", "\\x{00}")
_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
    SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown AS (SELECT *, contains(text, '###') OR contains(text, '</turn>') OR contains(text, '\\') OR ends_with(text, '\') AS clash,
    len(regexp_replace(text, '\\|###|</turn>', '\\\0', 'g')) AS escaped FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(len(role) + CASE WHEN clash THEN escaped ELSE len(text) END + 14) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""

OP4 = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{BLACK_WORD}')) AS BIGINT) AS size,
        md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))) AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM doc GROUP BY source),
turn AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight, source_size * 2.0::DOUBLE AS cap FROM src),
level AS (SELECT *, coalesce(sum(cap) OVER p, 0) AS capped, sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
        (SELECT 1.5::DOUBLE * sum(source_size) FROM src) AS budget
        FROM turn WINDOW p AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flat AS (SELECT coalesce(max((budget - capped) / rest) FILTER ((budget - capped) / rest < cap / weight), max(cap / weight)) AS l FROM level),
target AS (SELECT source, source_size, least(cap, weight * l) AS target, CAST(floor(least(cap, weight * l)) AS BIGINT) AS words FROM turn, flat),
placed AS (SELECT doc_id, size, source_size, target, words, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM doc d JOIN target t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + least(greatest(words - whole * source_size - before, 0), size) AS BIGINT) AS taken FROM placed
"""

OP7 = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP8 = f"""
WITH good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND toxic = 0),
doc AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, doc_id IN (SELECT doc_id FROM good WHERE doc_id IS NOT NULL) AS own, regexp_extract_all({_AZ}, '{ALNUM_WORD}') AS w FROM documents),
pair AS MATERIALIZED (SELECT rid, own, z[1] AS a, z[2] AS b FROM (SELECT rid, own, unnest(list_zip(list_concat([''], w[1:len(w) - 1]), w)) AS z FROM doc WHERE len(w) > 0)),
two AS (SELECT a, b, count(*) AS n, count(*) FILTER (own) AS m FROM pair GROUP BY a, b),
one AS MATERIALIZED (SELECT b AS w, count(*) AS n, count(*) FILTER (own) AS m FROM pair GROUP BY b
    UNION ALL SELECT '', count(*), count(*) FILTER (own) FROM doc WHERE len(w) > 0),
size AS (SELECT sum(n) AS n, sum(m) AS m, count(*) AS words FROM one WHERE w <> ''),
loss AS (SELECT rid, avg(-ln((two.m + 50.0::DOUBLE * (y.m + 1) / (size.m + words + 1)) / (x.m + 50.0::DOUBLE))) AS t,
        avg(-ln((two.n + 50.0::DOUBLE * (y.n + 1) / (size.n + words + 1)) / (x.n + 50.0::DOUBLE))) AS b
        FROM pair JOIN two USING (a, b) JOIN one x ON x.w = a JOIN one y ON y.w = b, size GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, round(t, 6) AS loss_target, round(b, 6) AS loss_background, round(t - b, 6) AS score
FROM doc LEFT JOIN loss USING (rid)
"""

OP9 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_AZ}, '{ALNUM_WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item, list_slice(w, i, least(i + 9, len(w))) AS g
        FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
doc AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_AZ}, '{ALNUM_WORD}') AS w FROM documents),
hit AS MATERIALIZED (SELECT d.rid, d.i, d.n, win.item FROM
        (SELECT rid, i, n, list_slice(w, i, i + n - 1) AS g FROM doc, lens, unnest(range(1, len(w) - n + 2)) AS r(i)) d
        JOIN win ON win.g = d.g),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(p) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)
"""


OP10 = f"""
WITH RECURSIVE doc AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_AZ}, '{BLACK_WORD}') AS w FROM documents),
pieces AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM doc, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS r(i) WHERE len(w) > 0),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM pieces GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM pieces a JOIN pieces b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM pair p JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * p.n >= 90 * (x.n + y.n - p.n)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM doc UNION
    SELECT r.doc_id, l.b FROM reach r JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', {0}) END"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + "))"
_CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len({0})), lambda i: CAST(ord({0}[i + 1]) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
#: tree 0 has the leaves by language, tree 1 the subroots; a step is a node's run on one level.
OP11 = f"""
WITH RECURSIVE doc AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, lang, {_LEAF.format('text')} AS leaf,
        CASE WHEN {_CRC32.format('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered FROM documents),
leaf AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM doc),
node AS MATERIALIZED (SELECT * FROM (WITH RECURSIVE up(lang, lvl, idx, n, h) AS (SELECT lang, 0, idx, n, leaf FROM leaf UNION ALL
        SELECT lang, any_value(lvl) + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lang, idx // 8) SELECT * FROM up)),
sub AS MATERIALIZED (SELECT lang, lvl AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
high AS MATERIALIZED (SELECT * FROM (WITH RECURSIVE up(lvl, idx, n, h) AS (SELECT 0, idx, n, h FROM sub UNION ALL
        SELECT any_value(lvl) + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY idx // 8) SELECT * FROM up)),
run AS MATERIALIZED (SELECT lang, lvl, idx // 8 AS p, list(h ORDER BY idx) AS hs FROM node WHERE n > 1 GROUP BY lang, lvl, idx // 8),
run2 AS MATERIALIZED (SELECT lvl, idx // 8 AS p, list(h ORDER BY idx) AS hs FROM high WHERE n > 1 GROUP BY lvl, idx // 8),
step AS MATERIALIZED (SELECT rid, r.lvl AS k, hs, (l.idx >> (3 * r.lvl)) % 8 AS place FROM leaf l JOIN run r ON r.lang IS NOT DISTINCT FROM l.lang AND r.p = l.idx >> (3 * r.lvl + 3)
    UNION ALL SELECT rid, s.height + r.lvl, hs, (s.idx >> (3 * r.lvl)) % 8 FROM leaf l JOIN sub s ON s.lang IS NOT DISTINCT FROM l.lang JOIN run2 r ON r.p = s.idx >> (3 * r.lvl + 3)),
side AS MATERIALIZED (SELECT rid, k, array_to_string(list_slice(hs, 1, place), '') AS a, array_to_string(list_slice(hs, place + 2, 8), '') AS b FROM step),
folded(rid, k, h) AS (SELECT rid, 0, coalesce(altered, leaf) FROM leaf UNION ALL SELECT f.rid, f.k + 1, sha256(concat(a, h, b)) FROM folded f JOIN side s ON s.rid = f.rid AND s.k = f.k),
proof AS (SELECT rid, sha256(string_agg(a || b, '' ORDER BY k)) AS proof FROM side GROUP BY rid)
SELECT doc_id, leaf, s.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM leaf l JOIN sub s ON s.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proof USING (rid)
JOIN (SELECT rid, arg_max(h, k) AS h FROM folded GROUP BY rid) f USING (rid), (SELECT h FROM high WHERE n = 1) root
"""


OP13 = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{BLACK_WORD}') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS f FROM doc GROUP BY t),
label AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cell AS MATERIALIZED (SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) AS c,
        regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > f, false) AS e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM doc JOIN first USING (t) LEFT JOIN label USING (doc_id) GROUP BY ALL),
mask AS MATERIALIZED (SELECT part, n, good, toxic, concat(if(a, 'A', ''), if(b, 'B', ''), if(c, 'C', ''), if(d, 'D', ''), if(e, 'E', '')) AS fails FROM cell),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS MATERIALIZED (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letter a, letter b, letter c, letter d, letter e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
step AS MATERIALIZED (SELECT filter_order, s AS step, filter_order[s] AS own, filter_order[1:s - 1] AS before FROM orders, unnest(range(1, 6)) AS r(s)),
found AS MATERIALIZED (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS failed, translate(fails, before, '') <> fails AS gone FROM mask, step),
result AS (SELECT part, filter_order, step, own, sum(n) FILTER (NOT gone AND NOT failed) AS kept, sum(n) FILTER (failed AND NOT gone) AS removed, sum(n) FILTER (failed AND gone) AS redundant,
        sum(n) FILTER (fails = own) AS unique_fails, sum(good) FILTER (failed AND NOT gone) AS good_lost, sum(toxic) FILTER (failed AND NOT gone) AS toxic_lost FROM found GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley FROM result
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": OP2, "op4_mix_sources": OP4, "op7_exact_top_k": OP7, "op8_lm_scoring": OP8, "op9_benchmark_decontamination": OP9, "op10_ngram_jaccard_join": OP10, "op11_merkle_manifest": OP11, "op13_filter_audit": OP13}
