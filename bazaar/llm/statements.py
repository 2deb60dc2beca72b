"""DuckDB SQL for the numbered operators that SQL can express.

The others (random draws, tokenizers, fitted models, line joins too slow for SQL on whole tables) are tested against plain
versions in tests/llm.
"""

from bazaar.llm import pii
from bazaar.llm.quality import POLICIES, RULES, mask_of

_WORD = r"[^\x20\x09-\x0D]+"
_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _count(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


def _components(node: str, links: str) -> str:
    """Recursive closure: every node with the smallest node that the links (a, b) lead to."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
    reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
    component AS (SELECT n.{node} AS node, least(n.{node}, min(r.b)) AS root
                  FROM nodes n LEFT JOIN reach r ON r.a = n.{node} GROUP BY n.{node})"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _climb(lang: str) -> str:
    """One level up: every 8 nodes become one while a tree has several."""
    return f"""SELECT {lang} lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 7) // 8
               FROM {{0}} WHERE n > 1 GROUP BY {lang} lvl, i // 8"""


def _crc32(text: str) -> str:
    """CRC-32 of a short text, bit by bit."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    for _ in range(7):
        step = f"list_transform([{step}], lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)[1]"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: list_transform([xor(a, b)], lambda c: {step})[1]), 4294967295)"


def _luhn(digits: str) -> str:
    each = "CASE WHEN i % 2 = 0 THEN (2 * c::INT) // 10 + (2 * c::INT) % 10 ELSE c::INT END"
    return f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: {each})) % 10 = 0"


def _mod97(account: str) -> str:
    codes = f"list_transform(string_split(substr({account}, 5) || left({account}, 4), ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE c::INT END)"
    return f"list_reduce(list_prepend(0, {codes}), lambda r, v: (r * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97) = 1"


#: The agreed base patterns as they are written, and the added ones.
_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
} | {k: pii.PATTERNS[k] for k in pii.KINDS[4:]}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_ALONE = "NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]')"
_ACCOUNT = "replace(m, ' ', '')"
_CHECKS = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: x::HUGEINT > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_luhn(_DIGITS)}",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"{_ALONE} AND length({_ACCOUNT}) BETWEEN 15 AND 34 AND {_mod97(_ACCOUNT)}",
    "ssn": "NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]') AND NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$')",
    "local_phone": "NOT regexp_matches(before, '[0-9+-]$|\\+[0-9][ ().0-9-]*$') AND NOT regexp_matches(after, '^[0-9-]')",
}


def _proposals(kind: str) -> str:
    return f"""SELECT doc_id, {pii.KINDS.index(kind)} AS k, '{kind}' AS kind, {kind in pii.BASE} AS base, f[i] AS m, right(g[i], {pii.BEFORE}) AS before,
        left(g[i + 1], {pii.AFTER}) AS after, (list_sum(list_transform(g[1:i] || f[1:i - 1], lambda x: length(x))))::BIGINT AS start,
        {pii.SCORES[kind]} AS own, '{pii.near(pii.WORDS[kind])}' AS words
        FROM (SELECT doc_id, f, g, unnest(generate_series(1, len(f))) AS i
              FROM (SELECT doc_id, regexp_extract_all(t, '{_PII[kind]}') AS f, string_split_regex(t, '{_PII[kind]}') AS g FROM texts))"""


def _confirmed(kind: str) -> str:
    around = f"translate(before || ' ' || after, '{_UPPER}', '{_LOWER}')"
    score = f"""own + CASE WHEN regexp_matches({around}, words) THEN {pii.STEP} ELSE 0 END
                - CASE WHEN regexp_matches({around}, '{pii.near(pii.AGAINST)}') THEN {pii.STEP} ELSE 0 END"""
    return f"SELECT *, {score} AS score FROM ({_proposals(kind)}) WHERE {_CHECKS[kind]}"


STATEMENTS: dict[str, str] = {
    "op4_ngram_jaccard": f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
    shingle AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM words WHERE len(w) > 0)),
    nodes AS (SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN shingle USING (doc_id) GROUP BY 1),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
              FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS (SELECT p.a, p.b FROM pairs p JOIN nodes x ON x.doc_id = p.a JOIN nodes y ON y.doc_id = p.b
              WHERE 100 * p.n >= 90 * (x.n + y.n - p.n)),
    {_components("doc_id", "links")}
    SELECT doc_id, n AS n_shingles, root AS component_id FROM nodes JOIN component ON node = doc_id""",
    "op6_quality_rules": f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM texts WHERE len(w) >= 8)),
    twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, generate_series(0, 7) AS g(k) GROUP BY 1),
    measured AS (
        SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
               {_count("[#*$%&|<>]")} AS n_symbols,
               len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) AS n_lines,
               n_lines - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))))
                   AS n_dup_lines,
               len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_bare_words,
               {_count("[A-Za-z]|[^\\x00-\\x7F]")} AS n_letters, {_count("[A-Z]")} AS n_capitals,
               {_count("[!?]")} AS n_exclamations, coalesce(c.n, 0) AS n_repeat_words
        FROM texts LEFT JOIN covered c USING (doc_id)),
    ledger AS (SELECT *, ({_BITS})::BIGINT AS failures FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           failures & {mask_of(POLICIES["base"])} <> 0 AS base_failed,
           failures & {mask_of(POLICIES["base"]) | mask_of(POLICIES["v2"])} = 0 AS kept, failures FROM ledger""",
    "op7_chat_formatting": """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS rank
        FROM conversations WHERE conv_id IS NOT NULL),
    talks AS (
        SELECT conv_id, count(*) AS n_turns, list(role || chr(0) || text ORDER BY rank) AS said,
               string_agg('<|' || replace(replace(role, '<|', '< |'), '|>', '| >') || '|>' || chr(10)
                          || replace(replace(text, '<|', '< |'), '|>', '| >') || chr(10), '' ORDER BY rank) AS text
        FROM turns GROUP BY conv_id),
    longer AS (SELECT DISTINCT x.conv_id FROM talks x JOIN talks y
               ON x.said[1] = y.said[1] AND y.n_turns > x.n_turns AND y.said[1:x.n_turns] = x.said)
    SELECT min(conv_id) AS conv_id, 0::BIGINT AS part, n_turns, count(*) AS n_snapshots, min(text) AS text
    FROM talks ANTI JOIN longer USING (conv_id) GROUP BY said, n_turns""",
    "op8_embedding_dedup": f"""
    WITH RECURSIVE nodes AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    usable AS (SELECT * FROM nodes WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
              ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95),
    {_components("vec_id", "links")},
    degree AS (SELECT a, count(DISTINCT b) AS n FROM both_ways GROUP BY 1)
    SELECT vec_id, coalesce(degree.n, 0) AS n_links, root AS component_id, vec_id = root AS kept
    FROM nodes JOIN component ON node = vec_id LEFT JOIN degree ON degree.a = vec_id""",
    "op12_pii_spans": f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    kept AS (SELECT *, kind || ':' || start || ':' || (start + length(m)) AS said FROM ({" UNION ALL ".join(map(_confirmed, pii.KINDS))})
             WHERE base OR score >= {pii.THRESHOLD}),
    per AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in pii.BASE)},
                   string_agg(said, ',' ORDER BY start, k) FILTER (WHERE base) AS b, string_agg(said, ',' ORDER BY start, k) AS a
            FROM kept GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.BASE)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
    FROM texts LEFT JOIN per USING (doc_id)""",
    "op11_merkle_manifest": f"""
    WITH RECURSIVE docs AS (
        SELECT *, {_leaf("text")} AS leaf, coalesce({_crc32("doc_id::VARCHAR")} % 3 = 0, false) AS hit,
               {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS low FROM documents),
    placed AS (
        SELECT doc_id, lang, leaf, CASE WHEN hit THEN low ELSE leaf END AS found, count(*) OVER (PARTITION BY lang) AS n,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM docs),
    tree(t, lvl, i, node, n) AS (
        SELECT t, 0, i, leaf, n FROM placed
        UNION ALL {_climb("t,").format("tree")}),
    subroots AS (SELECT t, node AS subroot, count(*) OVER () AS n FROM tree WHERE n = 1),
    top(lvl, i, node, n) AS (
        SELECT 0, t, subroot, n FROM subroots
        UNION ALL {_climb("").format("top")}),
    climb(row, t, lvl, i, cur, proof) AS (
        SELECT t * 1000000000 + i, t, 0, i, found, '' FROM placed
        UNION ALL
        SELECT c.row, c.t, c.lvl + 1, c.i // 8, sha256(string_agg(CASE WHEN x.i = c.i THEN c.cur ELSE x.node END, '' ORDER BY x.i)),
               c.proof || coalesce(string_agg(x.node, '' ORDER BY x.i) FILTER (WHERE x.i <> c.i), '')
        FROM climb c JOIN tree x ON x.t = c.t AND x.lvl = c.lvl AND x.i // 8 = c.i // 8 AND x.n > 1
        GROUP BY c.row, c.t, c.lvl, c.i, c.cur, c.proof),
    at_subroot AS (SELECT row, t, cur, proof FROM climb QUALIFY lvl = max(lvl) OVER (PARTITION BY row)),
    above(row, t, lvl, i, cur, proof) AS (
        SELECT row, t, 0, t, cur, proof FROM at_subroot
        UNION ALL
        SELECT c.row, c.t, c.lvl + 1, c.i // 8, sha256(string_agg(CASE WHEN x.i = c.i THEN c.cur ELSE x.node END, '' ORDER BY x.i)),
               c.proof || coalesce(string_agg(x.node, '' ORDER BY x.i) FILTER (WHERE x.i <> c.i), '')
        FROM above c JOIN top x ON x.lvl = c.lvl AND x.i // 8 = c.i // 8 AND x.n > 1
        GROUP BY c.row, c.t, c.lvl, c.i, c.cur, c.proof),
    ended AS (SELECT row, cur, proof FROM above QUALIFY lvl = max(lvl) OVER (PARTITION BY row)),
    numbered AS (SELECT t * 1000000000 + i AS row, * FROM placed)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
    FROM numbered JOIN ended USING (row) JOIN subroots USING (t), (SELECT node AS root FROM top WHERE n = 1)""",
}


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
