"""SQL twins of the queries that SQL can express, as brute force over all rows."""

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"'[^\x20\x09-\x0D]+'"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(table: str, key: str, pattern: str, fold: bool) -> str:
    text = "coalesce(text, '')"
    return f"SELECT {key}, regexp_extract_all({_FOLD.format(text) if fold else text}, {pattern}) AS words FROM {table}"


NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS ({_words("documents", "doc_id", _SPACE, True)}),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g
      FROM w, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS t(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
least_id AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least_id USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

REPEATED_WORDS = f"""
WITH w AS ({_words("documents", "doc_id", _SPACE, False)}),
wins AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS g FROM w, unnest(range(1, len(words) - 11)) AS t(i)),
firsts AS (SELECT g, min(doc_id) AS m FROM wins GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM wins JOIN firsts USING (g) WHERE m < doc_id),
every AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN rest USING (doc_id) LEFT JOIN cut USING (doc_id)"""

CONTAMINATION = f"""
WITH w AS ({_words("documents", "doc_id", _PLAIN, True)}),
b AS ({_words("benchmark", "item_id", _PLAIN, True)}),
windows AS (SELECT DISTINCT item_id, least(13, len(words)) AS k, array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS g
            FROM b, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS g FROM w, sizes, unnest(range(1, len(words) - k + 2)) AS t(i)),
found AS (SELECT doc_id, k, i, item_id FROM runs JOIN windows USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n > 0 AND 20 * hit.n >= len(words), FALSE) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    bits = "lambda x, k: xor(x >> 1, 3988292384 * (x & 1))"
    codes = f"list_transform(range(length({text})), lambda p: ascii(substr({text}, p + 1, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bits})), 4294967295)"


PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
           FROM conversations GROUP BY conv_id),
c AS (SELECT *, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM t),
r AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
      FROM c LEFT JOIN t b ON b.conv_id = c.conv_id - c.conv_id % 5),
m AS (SELECT conv_id AS member, depth, turns[1:depth] AS prefix, len(turns) AS n FROM r, unnest(range(len(turns) + 1)) AS u(depth)),
member AS (SELECT *, min(member) OVER (PARTITION BY prefix) AS conv_id FROM m),
node AS (SELECT conv_id, depth, count(*) AS n_convs, any_value(prefix[-1].text) AS last_text,
                string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (WHERE n = depth) AS ends
         FROM member GROUP BY conv_id, depth),
parent AS (SELECT node.conv_id, node.depth, member.conv_id AS parent_conv_id
           FROM node JOIN member ON member.member = node.conv_id AND member.depth = node.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM parent GROUP BY ALL),
weighed AS (SELECT node.*, coalesce(n, 0) AS n_children, (n_convs - 1) * coalesce(strlen(last_text), 0) AS saved
            FROM node LEFT JOIN children USING (conv_id, depth)),
subtree AS (SELECT member.conv_id, member.depth, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved_tokens
            FROM weighed w JOIN member ON member.member = w.conv_id AND member.depth <= w.depth GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(ends, '')) AS ends_sha256
FROM weighed JOIN subtree USING (conv_id, depth) LEFT JOIN parent USING (conv_id, depth)"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
                     WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r),
least_id AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
sizes AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least_id USING (vec_id) LEFT JOIN sizes USING (vec_id)"""


def _edit(letter: str, cost: str, after: str, turn: str | None = None) -> str:
    kept = f"list_prepend({turn}, {after}.r)" if turn else f"{after}.r"
    return f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, 'r': {kept}}}"


def _at(state: str, *edits: str) -> str:
    return f"list_min([{', '.join([_edit('D', '4', state), *edits])}])"


#: The next turn as the user's or the assistant's: kept if it is, given that role if not; out of reach where it must be deleted.
_USER, _ASSISTANT = (
    f"CASE WHEN initial = '{role[0]}' THEN {_edit('K', 'stay', after, 'shown')} ELSE {_edit('R', 'stay + 3', after, repr(role + ':') + ' || text')} END"
    for role, after in (("user", "fa"), ("assistant", "fe"))
)
_SYSTEM = f"CASE WHEN initial = 's' THEN {_edit('K', 'stay', 'fs', 'shown')} ELSE {_edit('D', '4', 'f0')} END"
_INSERT_USER, _INSERT_ASSISTANT = (_edit("I", "3", after, f"'{role}:'") for role, after in (("user", "ha"), ("assistant", "he")))
_NO_TURNS = "{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}"

REPAIRED = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (SELECT *, {_crc32("key")} % 20 AS kind FROM k),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM h, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(copy)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (SELECT *, role[1] AS initial, role || ':' || text AS shown, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault FROM numbered),
rows AS (SELECT *, CASE fault WHEN 'blank' THEN 1000000 WHEN 'duplicate' THEN 1000000 WHEN 'truncated' THEN 3 ELSE 0 END AS stay FROM judged),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id),
steps AS (
    SELECT conv_id, n + 1 AS i, {_NO_TURNS} AS f0, {{'c': 6::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS fs,
           {{'c': 3::BIGINT, 'a': 'I', 'r': ['assistant:']}} AS fa, {_NO_TURNS} AS fe FROM counts
    UNION ALL
    SELECT conv_id, i, list_min([h0, {_INSERT_USER}, {_edit("I", "3", "b", "'user:'")}]), list_min([hs, {_INSERT_USER}, {_edit("I", "3", "b", "'user:'")}]),
           list_min([ha, b]), list_min([he, {_INSERT_USER}])
    FROM (SELECT *, {_INSERT_ASSISTANT} AS b FROM (
        SELECT conv_id, rows.i, {_at("f0", _SYSTEM, _USER)} AS h0, {_at("fs", _USER)} AS hs, {_at("fa", _ASSISTANT)} AS ha, {_at("fe", _USER)} AS he
        FROM steps JOIN rows USING (conv_id) WHERE rows.i = steps.i - 1))),
best AS (SELECT conv_id, f0 FROM steps WHERE i = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f0.c, 0) AS cost, coalesce(f0.a, '') AS audit,
       sha256(coalesce(array_to_string(f0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN best USING (conv_id)"""
