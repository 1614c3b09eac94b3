"""SQL twins of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from pitmark.llm.license_rules import KEYWORDS, REACH, RULES
from pitmark.llm.secrets import KINDS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_COMPONENTS = """s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT id n, id c FROM ids UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.n WHERE r.c < s.b), comp AS (SELECT n, min(c) c FROM r GROUP BY 1)"""

NEAR_DUPLICATES = rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w FROM documents),
    sh AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END s FROM w),
    x AS MATERIALIZED (SELECT doc_id, len(s) n, unnest(s) t FROM sh), ids AS (SELECT DISTINCT doc_id id FROM documents),
    e AS MATERIALIZED (SELECT a.doc_id a, b.doc_id b FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))), {_COMPONENTS}
    SELECT doc_id, len(s) n_shingles, c component_id, doc_id = c kept FROM sh JOIN comp ON n = doc_id"""

EMBEDDINGS = f"""WITH RECURSIVE v AS (SELECT vec_id, "label", CAST(embedding AS DOUBLE[]) x FROM embeddings), u AS (SELECT *, sqrt(list_dot_product(x, x)) n FROM v WHERE "label" IS NOT NULL AND len(x) > 0 AND list_dot_product(x, x) > 0), ids AS (SELECT DISTINCT vec_id id FROM v),
    e AS MATERIALIZED (SELECT a.vec_id a, b.vec_id b FROM u a JOIN u b ON a."label" = b."label" AND a.vec_id < b.vec_id WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.93), {_COMPONENTS}
    SELECT vec_id, (SELECT count(*) FROM s WHERE s.a = vec_id) n_links, c component_id, vec_id = c kept FROM v JOIN comp ON n = vec_id"""


def _hits(k: int) -> str:
    _, pattern, group, least = KINDS[k]
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT r, o, p, {k} k, st s, st + length(m[i]) e, v[i] val FROM (SELECT *, list_sum([length(q) FOR q IN s[1:i]]) + coalesce(list_sum([length(q) FOR q IN m[1:i - 1]]), 0) st FROM (
        SELECT *, unnest(range(1, len(m) + 1)) i FROM (SELECT r, o, p, regexp_extract_all(t, {p}, 0) m, regexp_extract_all(t, {p}, {group}) v, string_split_regex(t, {p}) s FROM d WHERE regexp_matches(t, {p})))) WHERE length(v[i]) >= {least}"""


_NAMES = "[" + ", ".join(f"'{k[0]}'" for k in KINDS) + "]"
SECRETS = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () r, doc_id, coalesce(text, '') t, coalesce(source, '') o, coalesce(lang, '') p FROM documents),
    base AS MATERIALIZED ({" UNION ALL ".join(map(_hits, range(3)))}), bare AS MATERIALIZED ({_hits(3)}),
    hits AS MATERIALIZED (SELECT * FROM base UNION ALL SELECT * FROM bare x WHERE length(regexp_replace(val, '[^0-9]', '', 'g')) >= 4 AND length(regexp_replace(val, '[^A-Za-z]', '', 'g')) >= 4 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = x.r AND b.s < x.e AND x.s < b.e)),
    owners AS (SELECT val, CASE WHEN count(DISTINCT o) >= 3 THEN 'example' WHEN count(DISTINCT o) = 1 THEN 'live' ELSE 'shared' END standing FROM hits GROUP BY 1), h AS (SELECT * FROM hits JOIN owners USING (val) WHERE k < 3 OR standing = 'live')
    SELECT doc_id, {", ".join(f"count(*) FILTER (k = {i}) n_{k[0]}" for i, k in enumerate(KINDS))}, sha256(coalesce(string_agg({_NAMES}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3), '')) base_sha256, coalesce(string_agg({_NAMES}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k), '') spans,
    {", ".join(f"count(*) FILTER (standing = '{x}') n_{x}" for x in ("live", "shared", "example"))} FROM d LEFT JOIN h USING (r) GROUP BY r, doc_id"""

_TEXTS = ", ".join(f"({r.rank}, {r.strength}, '{r.label}', '{r.keyword}', '{f'(?:^| ){r.before}$' if r.before else ''}', '^{r.keyword}{r.after} ', {r.base})" for r in RULES)
_SPACES = lambda x: f"(length({x}) - length(replace({x}, ' ', '')))"
LICENSES = rf"""WITH rules(rank, strength, "label", keyword, before, after, base) AS (VALUES {_TEXTS}),
    d AS MATERIALIZED (SELECT row_number() OVER () r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w FROM documents),
    p AS MATERIALIZED (SELECT r, i - 1 pos, w[i] word, CASE WHEN i > 1 THEN array_to_string(w[greatest(1, i - {REACH}):i - 1], ' ') || ' ' ELSE '' END ahead, array_to_string(w[i:i + {REACH}], ' ') || ' ' behind
        FROM (SELECT r, w, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains({KEYWORDS}, w[i]))) i FROM d)),
    f AS MATERIALIZED (SELECT r, pos - CASE WHEN before = '' THEN 0 ELSE {_SPACES("ltrim(regexp_extract(ahead, before))")} END s, pos + {_SPACES("regexp_extract(behind, after)")} e, rank, strength, "label", base
        FROM p JOIN rules ON keyword = word WHERE (before = '' OR regexp_matches(ahead, before)) AND regexp_matches(behind, after)),
    g AS (SELECT *, NOT EXISTS (SELECT 1 FROM f x WHERE x.r = f.r AND (x.s <= f.s AND f.e <= x.e OR f.s <= x.s AND x.e <= f.e) AND (x.strength, x.e - x.s, -x.rank) > (f.strength, f.e - f.s, -f.rank)) stays FROM f)
    SELECT doc_id, len(w) n_words, count(*) FILTER (base) n_base, min(s) FILTER (base) first_word, max(s) FILTER (base) last_word, coalesce(string_agg(DISTINCT "label", ',' ORDER BY "label") FILTER (base), '') base_labels,
    coalesce(string_agg(DISTINCT "label", ',' ORDER BY "label") FILTER (base OR stays), '') labels, coalesce(max(strength) FILTER (stays), 0) / 4 score FROM d LEFT JOIN g USING (r) GROUP BY r, doc_id, w"""

#: One step of the repair: from each state and the best way to it, by up to two inserted rows and then an edit of the next row.
_INSERTED = """SELECT conv, i, CASE st WHEN 2 THEN 3 ELSE 2 END st, {'cost': x.cost + 3, 'audit': x.audit || 'I', 'said': list_append(x.said, CASE st WHEN 2 THEN 'assistant:' ELSE 'user:' END)} x FROM"""
CONVERSATIONS = rf"""WITH RECURSIVE bits(b, k, v) AS (SELECT b, 0, b FROM (SELECT unnest(range(256)) b) UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
    crc AS (SELECT list(v ORDER BY b) t FROM bits WHERE k = 8),
    c AS (SELECT conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') s FROM conversations),
    h AS (SELECT c.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda z: CAST(ord(z) AS BIGINT))), lambda p, z: xor(p >> 8, t[CAST(xor(p, z) & 255 AS INTEGER) + 1])), 4294967295) % 20 k FROM c, crc),
    w AS (SELECT conv_id conv, turn, CASE k WHEN 4 THEN 'user' ELSE role END role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END text FROM h, range(2) twice(n) WHERE k <> 0 AND (n = 0 OR k = 3)),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) i FROM w),
    r AS MATERIALIZED (SELECT conv, i, turn, role, text, left(role, 1) a, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) z, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 again FROM o),
    f AS MATERIALIZED (SELECT *, CASE WHEN z = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN z NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END fault, lag(a) OVER (PARTITION BY conv ORDER BY i) b FROM r),
    steps(conv, i, st, x) AS (SELECT DISTINCT conv, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'said': CAST([] AS VARCHAR[])}} FROM f UNION ALL
        SELECT conv, i, u.st, min(u.x) FROM (SELECT e.conv, e.i + 1 i, unnest([{{'st': e.st, 'x': {{'cost': e.x.cost + 4, 'audit': e.x.audit || 'D', 'said': e.x.said}}}},
                CASE WHEN fault IN ('', 'truncated') AND (e.st, a) IN ((0, 's'), (0, 'u'), (1, 'u'), (3, 'u'), (2, 'a')) THEN {{'st': CASE a WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'x': {{'cost': e.x.cost + CASE fault WHEN '' THEN 0 ELSE 3 END, 'audit': e.x.audit || 'K', 'said': list_append(e.x.said, role || ':' || text)}}}} END,
                CASE WHEN fault IN ('', 'truncated') THEN {{'st': CASE e.st WHEN 2 THEN 3 ELSE 2 END, 'x': {{'cost': e.x.cost + CASE fault WHEN '' THEN 3 ELSE 6 END, 'audit': e.x.audit || 'R', 'said': list_append(e.x.said, CASE e.st WHEN 2 THEN 'assistant:' ELSE 'user:' END || text)}}}} END]) u
            FROM (SELECT * FROM steps UNION ALL {_INSERTED} steps UNION ALL {_INSERTED} ({_INSERTED} steps)) e JOIN f ON f.conv IS NOT DISTINCT FROM e.conv AND f.i = e.i + 1) WHERE u IS NOT NULL GROUP BY conv, i, u.st),
    ends AS (SELECT conv, max(i) i FROM f GROUP BY 1), last AS (SELECT s.* FROM steps s JOIN ends e ON e.conv IS NOT DISTINCT FROM s.conv AND e.i = s.i),
    best AS (SELECT conv, min(x) x FROM (SELECT * FROM last UNION ALL {_INSERTED} last UNION ALL {_INSERTED} ({_INSERTED} last)) WHERE st IN (0, 3) GROUP BY 1),
    g AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) gaps, count(*) FILTER (fault = 'blank') blank, count(*) FILTER (fault = 'duplicate') duplicate, count(*) FILTER (fault = 'truncated') truncated, count(*) FILTER (b IS NOT NULL AND b || a NOT IN ('su', 'ua', 'au')) illegal FROM f GROUP BY 1)
    SELECT d.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, coalesce(x.cost, 0) AS "cost", coalesce(x.audit, '') audit, sha256(coalesce(array_to_string(x.said, chr(10)), '')) repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN g ON g.conv IS NOT DISTINCT FROM d.conv_id LEFT JOIN best ON best.conv IS NOT DISTINCT FROM d.conv_id"""

ORACLES = {"op5_minhash": NEAR_DUPLICATES, "op7_secrets": SECRETS, "op10_embedding_dedup": EMBEDDINGS, "op12_licenses": LICENSES, "op13_conversation_repair": CONVERSATIONS}
