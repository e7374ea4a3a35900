"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tunetrail.llm.licenses import COPYRIGHT, KNOWN, SPELLINGS

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce({_ASCII_LOWER.format('text')}, ''), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) item, list_filter(regexp_split_to_array({_ASCII_LOWER.format('text')}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(w), 13) n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') k
      FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM p),
win AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') k FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
hit AS (SELECT DISTINCT doc_id, i, n, item FROM win JOIN p USING (n, k)),
pos AS (SELECT doc_id, count(DISTINCT j) n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hit), unnest(range(i, i + n)) t(j) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) n_items, array_to_string(list_sort(list(DISTINCT item)), ',') ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_SPANS = """
{kind}_a AS (SELECT doc_id, source, lang, regexp_split_to_array(text, {p}) s, regexp_extract_all(text, {p}, 0) m, regexp_extract_all(text, {p}, {g}) v
             FROM documents WHERE regexp_matches(text, {p})),
{kind} AS (SELECT doc_id, source, lang, '{kind}' kind, {k} k, v[i] val,
                  list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a, length(m[i]) n
           FROM {kind}_a, unnest(range(1, len(m) + 1)) t(i) WHERE {ok})"""
_VALUE = r"""'((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""

OP1 = "WITH" + ",".join([
    _SPANS.format(kind="assign", k=1, p=_VALUE, g=2, ok="length(v[i]) >= 6"),
    _SPANS.format(kind="access", k=2, p="'AKIA[A-Z0-9]+'", g=0, ok="length(m[i]) >= 20"),
    _SPANS.format(kind="hex", k=3, p="'[0-9a-f]+'", g=0, ok="length(m[i]) >= 24"),
    _SPANS.format(kind="token", k=4, p="'[A-Za-z0-9+/_-]+'", g=0, ok="length(m[i]) >= 24 AND regexp_matches(m[i], '[0-9]') AND regexp_matches(m[i], '[A-Z]') AND regexp_matches(m[i], '[a-z]')"),
]) + """,
found AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex UNION ALL SELECT * FROM token),
held AS (SELECT val, count(DISTINCT coalesce(source, '')) n_owners, count(DISTINCT (coalesce(source, ''), coalesce(lang, ''))) n_repos, count(DISTINCT doc_id) n_docs FROM found GROUP BY val),
owned AS (SELECT *, n_owners >= 3 OR (n_repos >= 5 AND n_docs <= 3 * n_repos) example FROM held),
judged AS (SELECT f.*, n_owners, n_repos, n_docs, example, NOT example AND len(list_distinct(string_split(val, ''))) >= 8 live FROM found f JOIN owned USING (val)),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') n_assign, count(*) FILTER (kind = 'access') n_access, count(*) FILTER (kind = 'hex') n_hex,
               count(*) FILTER (kind = 'token') n_token, count(*) FILTER (live) n_live, count(*) FILTER (example) n_example,
               max(n_owners) most_owners, max(n_repos) most_repos, max(n_docs) most_docs,
               string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, k) FILTER (kind <> 'token') base,
               string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, k) spans
        FROM judged WHERE kind <> 'token' OR live GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex, sha256(coalesce(base, '')) base_sha256,
       coalesce(spans, '') spans, coalesce(n_token, 0) n_token, coalesce(n_live, 0) n_live, coalesce(n_example, 0) n_example,
       coalesce(most_owners, 0) most_owners, coalesce(most_repos, 0) most_repos, coalesce(most_docs, 0) most_docs
FROM documents d LEFT JOIN per USING (doc_id)
"""

OP4 = """
WITH v AS (SELECT vec_id, embedding, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op5() -> str:
    plain = f"regexp_replace(lower(regexp_replace(coalesce(text, ''), {_quoted('(?im)' + COPYRIGHT)}, '', 'g')), '[^\\p{{L}}\\p{{N}}\\n]+', '  ', 'g')"
    worded = f"' ' || replace({plain}, chr(10), ' ' || chr(10) || ' ') || ' '"

    def finished(x: str) -> str:
        out = f"(' ' || trim(regexp_replace(replace({x}, chr(10), ''), ' {{3,}}', '  ', 'g')) || ' ')"
        for said, meant in SPELLINGS:
            out = f"replace({out}, {_quoted(' ' + said.replace(' ', '  ') + ' ')}, {_quoted(' ' + meant.replace(' ', '  ') + ' ')})"
        return f"replace(trim({out}), '  ', ' ')"

    known = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, _, t in KNOWN)
    return f"""
WITH k AS (SELECT sha256({finished('w')}) digest, min(id) id FROM (SELECT id, {worded} w FROM (VALUES {known}) v(id, text)) GROUP BY 1),
d AS (SELECT doc_id, {worded} w FROM documents),
u AS (SELECT doc_id, 'text' unit, w FROM d UNION ALL SELECT doc_id, 'line', unnest(string_split(w, chr(10))) FROM d
      UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(w, '\\n[ ]*\\n')) FROM d),
c AS (SELECT doc_id, unit, {finished('w')} canon FROM u),
m AS (SELECT doc_id, unit, sha256(canon) digest, CASE WHEN canon <> '' THEN id END id FROM c LEFT JOIN k ON sha256(canon) = k.digest WHERE unit = 'text' OR canon <> '')
SELECT doc_id, max(digest) FILTER (unit = 'text') canon_sha256, max(id) FILTER (unit = 'text') license_id, count(id) FILTER (unit = 'line') n_lines,
       count(id) FILTER (unit = 'paragraph') n_paragraphs, coalesce(array_to_string(list_sort(list(DISTINCT id) FILTER (id IS NOT NULL)), ','), '') licenses
FROM m GROUP BY doc_id
"""


OP5 = _op5()

OP10 = r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) ls FROM documents),
l AS (SELECT doc_id, source, i pos, ls[i] raw, trim(regexp_replace(ls[i], '[\t\r]+', ' ', 'g')) line FROM d, unnest(range(1, len(ls) + 1)) t(i)),
wide AS (SELECT line, min(row(doc_id, pos)) AS first FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 5),
m AS (SELECT doc_id, pos, raw, wide.line IS NOT NULL AND row(doc_id, pos) <> first AS gone FROM l LEFT JOIN wide USING (line))
SELECT doc_id, count(*) n_lines, count(*) FILTER (gone) n_removed,
       length(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) n_chars_clean,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) clean_sha256
FROM m GROUP BY doc_id
"""

OP11 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) own FROM t GROUP BY conv_id),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                    lambda s, b: CASE WHEN xor(s, b) & 1 = 1 THEN xor(xor(s, b) >> 1, 3988292384) ELSE xor(s, b) >> 1 END), 4294967295) % 4 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(CASE WHEN b.own IS NULL THEN [] ELSE b.own[1:h.h] END, h.own[h.h + 1:]) turns FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20),
n AS (SELECT turns[1:d] p, d, min(conv_id) conv_id, count(*) n FROM r, unnest(range(0, len(turns) + 1)) u(d) GROUP BY 1, 2),
k AS (SELECT p[1:d - 1] p, count(*) kids FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(kids, 0) kids, CASE WHEN d > 0 THEN (n - 1) * len(list_filter(regexp_split_to_array(p[d].t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) ELSE 0 END saves FROM n LEFT JOIN k USING (p)),
s AS (SELECT p[1:e] p, sum(saves)::BIGINT saved_tokens, count(*) FILTER (kids = 0) n_leaves FROM v, unnest(range(0, d + 1)) u(e) GROUP BY 1),
e AS (SELECT turns p, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) ends FROM r GROUP BY 1)
SELECT v.conv_id, v.d AS depth, up.conv_id parent_conv_id, v.n n_convs, v.kids n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) ends_sha256
FROM v JOIN s USING (p) LEFT JOIN e USING (p) LEFT JOIN v up ON v.d > 0 AND up.p = v.p[1:v.d - 1]
"""

OP13 = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_ASCII_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') w FROM pieces),
o AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) i FROM w, (VALUES (1), (2), (3)) s(k)),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') phrase, count(*) f FROM o GROUP BY ALL),
total AS (SELECT lang, sum(f) n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') ws FROM g WHERE k > 1 AND f >= 10),
parts AS (SELECT c.*, x, array_to_string(ws[1:x], ' ') p1, array_to_string(ws[x + 1:], ' ') p2 FROM c, (VALUES (1), (2)) u(x) WHERE x < k),
cut AS (SELECT c.lang, c.phrase, c.k, c.f a, x, l.f l, r.f r, (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) score
        FROM parts c JOIN g l ON l.lang = c.lang AND l.phrase = p1 JOIN g r ON r.lang = c.lang AND r.phrase = p2),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1),
longer AS (SELECT lang, array_to_string(p, ' ') phrase, max(f) f FROM (SELECT lang, f, unnest([ws[1:2], ws[2:3]]) p FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer o ON k = 2 AND o.lang = best.lang AND o.phrase = best.phrase WHERE o.f IS NULL OR 100 * o.f < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT n, score::BIGINT score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op1_secret_scans": OP1,
    "op3_benchmark_decontamination": OP3,
    "op4_exact_top_k": OP4,
    "op5_license_scans": OP5,
    "op10_line_dedup": OP10,
    "op11_conversation_prefix_trie": OP11,
    "op13_phrase_collocation": OP13,
}
