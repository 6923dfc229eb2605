"""DuckDB SQL for the registered queries that SQL can express.

Each states the result plainly, without the operator's way to it: exact counts instead of
sketches, all pairs that share a shingle instead of signatures. The secret scan's lexer, the
language model and the tokenizers are tested against brute force instead.
"""

from __future__ import annotations

from tripmill.llm.collocations import LEAST_COUNT, MOST_WORDS, NO_LANGUAGE, TOP
from tripmill.llm.decontaminate import LEAST_WORDS, REPLACED, WINDOW
from tripmill.llm.line_dedup import LEAST_SITES
from tripmill.llm.near_dup import PERCENT, SHINGLE
from tripmill.llm.queries import RECORD_BYTES, SHARDS, URL_RULES
from tripmill.llm.sharding import DIGITS as DRAW_DIGITS
from tripmill.llm.spot_signatures import ANCHORS, CHAIN, DIGITS, LEAST_COMPARED, REACH
from tripmill.llm.url_filter import LOWER, UPPER

_BLANKS = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH split AS (
    SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, source, unnest(parts) AS raw, unnest(range(len(parts))) AS place FROM split
), solid AS (
    SELECT doc_id, source, place, trim(raw, {_BLANKS}) AS line FROM lines
    WHERE trim(raw, {_BLANKS}) <> ''
), common AS (
    SELECT line FROM solid GROUP BY line HAVING count(DISTINCT source) >= {LEAST_SITES}
), hits AS (
    SELECT doc_id, place, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS turn
    FROM solid JOIN common USING (line)
), gone AS (SELECT doc_id, place FROM hits WHERE turn > 1),
rest AS (
    SELECT doc_id, string_agg(raw, chr(10) ORDER BY place) AS text
    FROM lines ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
), counted AS (SELECT doc_id, count(*) AS n FROM solid GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(r.n, 0) AS n_removed,
    CASE WHEN r.n IS NULL THEN d.text ELSE coalesce(rest.text, '') END AS text
FROM documents d LEFT JOIN counted c USING (doc_id) LEFT JOIN removed r USING (doc_id)
LEFT JOIN rest USING (doc_id)
"""

MINHASH_DEDUP = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {SHINGLE}
        THEN list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: list_aggregate(w[i:i + {SHINGLE - 1}], 'string_agg', ' '))
        ELSE [list_aggregate(w, 'string_agg', ' ')] END) AS s
    FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= {PERCENT} * (x.n + y.n - shared.n)
), neighbours AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT doc_id AS node, doc_id AS other FROM documents
    UNION
    SELECT node, neighbours.b FROM reached JOIN neighbours ON neighbours.a = reached.other
), roots AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id,
    d.doc_id = r.component_id AS kept
FROM documents d JOIN roots r ON r.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_ANCHORS = "[" + ", ".join(f"'{word}'" for word in ANCHORS) + "]"


def _spots(text: str) -> str:
    """The sorted spot hashes of a text, as a list."""
    words = f"list_filter(string_split_regex(lower({text}), '[^\\pL\\pN]+'), lambda x: x <> '')"
    return f"""(
    SELECT list_sort(list_distinct(list_transform(
        CASE WHEN len(spots) > 0 THEN spots
             WHEN {text} = '' THEN CAST([] AS VARCHAR[])
             WHEN len(w) = 0 THEN ['=' || {text}]
             WHEN len(w) <= {CHAIN} THEN ['=:' || array_to_string(w, ':')]
             ELSE list_transform(range(1, len(w) - {CHAIN - 1}), lambda i: '=:' || array_to_string(w[i:i + {CHAIN}], ':'))
        END, lambda s: CAST((CAST('0x' || substr(md5(s), 1, {DIGITS}) AS UBIGINT)::HUGEINT + 9223372036854775808)
            % 18446744073709551616 - 9223372036854775808 AS BIGINT))))
    FROM (SELECT w, list_filter(list_transform(
        list_filter(range(1, len(w) + 1), lambda i: list_contains({_ANCHORS}, w[i])),
        lambda i: array_to_string(list_concat([w[i]], list_slice(
            list_filter(w[i + 1:i + {REACH}], lambda x: NOT list_contains({_ANCHORS}, x)), 1, {CHAIN})), ':')),
        lambda s: contains(s, ':')) AS spots
    FROM (SELECT {words} AS w)))"""


def _likeness(a: str, b: str) -> str:
    shared = f"len(list_intersect({a}, {b}))"
    return (
        f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::DOUBLE WHEN len({a}) = 0 OR len({b}) = 0 "
        f"OR least(len({a}), len({b})) < {LEAST_COMPARED} * greatest(len({a}), len({b})) - 1e-9 "
        f"THEN 0.0::DOUBLE ELSE {shared}::DOUBLE / (len({a}) + len({b}) - {shared}) END"
    )


FINGERPRINTS = f"""
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        coalesce(lead(coalesce(text, '')) OVER later,
            first_value(coalesce(text, '')) OVER later) AS following
    FROM documents WINDOW later AS (ORDER BY doc_id DESC)
), edits AS (
    SELECT *, substr(text, 1, n - n // 3) || substr(following, 1, n // 3) AS edited FROM ordered
), printed AS (
    SELECT doc_id, n, edited, {_spots("text")} AS a, {_spots("edited")} AS b, {_spots("following")} AS c
    FROM edits
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
    array_to_string(a, ',') AS fingerprint, array_to_string(b, ',') AS edited_fingerprint,
    {_likeness("a", "b")} AS near_edited, {_likeness("a", "c")} AS near_next
FROM printed
"""

# The cheapest repair state by state: 0 nothing, 1 system, 2 user, 3 assistant.
CONVERSATIONS = r"""
WITH RECURSIVE steps AS (
    SELECT list(value ORDER BY byte) AS t FROM (
        SELECT byte, list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1
            THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, byte) AS value
        FROM (SELECT unnest(range(256)) AS byte))
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h
    FROM conversations
), summed AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(
        list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
    FROM keyed, steps
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM summed WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
    FROM damaged
), judged AS (
    SELECT *, substr(role, 1, 1) AS initial, CASE WHEN solid = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
        WHEN right(solid, 1) IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1) AS pair
    FROM placed
), insertions(s, t, cost, edits, lines) AS (VALUES
    (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 2, 'I', E'user:
'), (1, 2, 2, 'I', E'user:
'), (3, 2, 2, 'I', E'user:
'), (2, 3, 2, 'I', E'assistant:
'),
    (0, 3, 4, 'II', E'user:
assistant:
'), (1, 3, 4, 'II', E'user:
assistant:
')
), edits(initial, s, t, cost, edit) AS (VALUES
    ('*', 0, 0, 3, 'D'), ('*', 1, 1, 3, 'D'), ('*', 2, 2, 3, 'D'), ('*', 3, 3, 3, 'D'),
    ('*', 0, 2, 2, 'R'), ('*', 1, 2, 2, 'R'), ('*', 3, 2, 2, 'R'), ('*', 2, 3, 2, 'R'),
    ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'), ('u', 3, 2, 0, 'K'), ('a', 2, 3, 0, 'K')
), walked AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS out
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, place, state, cost, audit, out FROM (
        SELECT w.conv_id, j.place, e.t AS state,
            w.cost + i.cost + e.cost + CASE WHEN j.fault = 'truncated' AND e.edit <> 'D' THEN 1 ELSE 0 END AS cost,
            w.audit || i.edits || e.edit AS audit,
            w.out || i.lines || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN j.role || ':' || j.text || chr(10)
                ELSE CASE e.t WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || j.text || chr(10) END AS out
        FROM walked w JOIN judged j ON j.conv_id = w.conv_id AND j.place = w.place + 1
        JOIN insertions i ON i.s = w.state
        JOIN edits e ON e.s = i.t AND e.initial IN ('*', j.initial)
            AND (e.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
), ended AS (
    SELECT w.conv_id, w.cost + i.cost AS cost, w.audit || i.edits AS audit, w.out || i.lines AS out
    FROM walked w JOIN insertions i ON i.s = w.state AND i.t IN (0, 3)
    WHERE w.place = (SELECT count(*) FROM judged j WHERE j.conv_id = w.conv_id)
    QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + i.cost, w.audit || i.edits) = 1
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    cost, audit, sha256(CASE WHEN out = '' THEN '' ELSE left(out, length(out) - 1) END) AS repaired_sha256
FROM ended LEFT JOIN counted USING (conv_id)
"""

# The checksum is the usual one with the reversed polynomial 0xEDB88320, a byte at a time.
SHARDING = f"""
WITH steps AS (
    SELECT list(value ORDER BY byte) AS t FROM (
        SELECT byte, list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1
            THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, byte) AS value
        FROM (SELECT unnest(range(256)) AS byte))
), records AS (
    SELECT doc_id, strlen(coalesce(text, '')) + {RECORD_BYTES} AS size,
        hex(encode(coalesce(text, ''))) AS h
    FROM documents
), summed AS (
    SELECT doc_id, size, xor(list_reduce(
        list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
    FROM records, steps
), draws AS (
    SELECT doc_id, size, text_crc32, s AS shard, -ln((CAST('0x' || substr(
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || s), 1, {DRAW_DIGITS}) AS BIGINT) + 0.5)
        / {16**DRAW_DIGITS}.0::DOUBLE) AS cost
    FROM summed, range({SHARDS + 1}) AS r(s)
), placed AS (
    SELECT doc_id, any_value(size) AS size, any_value(text_crc32) AS text_crc32,
        CAST(arg_min(shard, cost) FILTER (shard < {SHARDS}) AS INTEGER) AS shard,
        CAST(arg_min(shard, cost) AS INTEGER) AS grown_shard
    FROM draws GROUP BY doc_id
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

URL_FILTER = f"""
WITH rules(host, path, verdict) AS (VALUES {_RULES}),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
    FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), fits AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC,
            length(r.host) DESC, r.verdict DESC) AS turn
    FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
        AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE turn = 1
"""

# Items shorter than the window would have to occur as a whole; the tables hold none.
DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda x: x <> '') AS w
    FROM documents
), items AS (
    SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda x: x <> '') AS w
    FROM benchmark
), doc_runs AS (
    SELECT doc_id, unnest(range(1, len(w) - 2)) AS i,
        unnest(list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' '))) AS run
    FROM docs WHERE len(w) >= {LEAST_WORDS}
), item_runs AS (
    SELECT item_id, unnest(range(1, len(w) - 2)) AS j,
        unnest(list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' '))) AS run
    FROM items WHERE len(w) >= {WINDOW}
), shifts AS (SELECT DISTINCT doc_id, item_id, i - j AS shift FROM doc_runs JOIN item_runs USING (run)),
equal AS (
    SELECT doc_id, item_id, shift, p, len(x.w) AS n,
        CASE WHEN p + shift >= 1 AND p + shift <= len(d.w) AND x.w[p] = d.w[p + shift] THEN 1 ELSE 0 END AS same
    FROM shifts JOIN docs d USING (doc_id) JOIN items x USING (item_id),
        unnest(range(1, len(x.w) + 1)) AS u(p)
), stretches AS (
    SELECT doc_id, item_id, n, p, greatest(p + shift - 1, 0) AS at_word, sum(same) OVER (
        PARTITION BY doc_id, item_id, shift ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING
    ) AS same_words
    FROM equal
)
SELECT doc_id, item_id, CAST(max(same_words) AS BIGINT) AS same_words,
    CAST(arg_min(at_word, (-same_words, at_word)) AS BIGINT) AS at_word
FROM stretches WHERE p <= n - {WINDOW - 1} AND same_words >= {WINDOW - REPLACED}
GROUP BY doc_id, item_id
"""

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, {MOST_WORDS + 1}) AS r(k))
), counted AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}
), own AS (
    SELECT * FROM counted p WHERE k > 1 AND NOT EXISTS (
        SELECT 1 FROM counted q WHERE q.lang = p.lang AND q.k > p.k AND 100 * q.f >= 100 * p.f
            AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
), cuts AS (
    SELECT lang, phrase, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM own
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, cut,
        CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN sizes USING (lang)
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
), best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS turn FROM scored
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM best WHERE turn = 1
QUALIFY rank <= {TOP}
"""

# The given pages have an article element, and character references of two kinds in it.
HTML_TEXT = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS body FROM pages
), plain AS (
    SELECT page_id, url, regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS body
    FROM articles
), decoded AS (
    SELECT page_id, url, trim(regexp_replace(replace(replace(body, '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text
    FROM plain
)
SELECT page_id, url, text, length(text) AS n_chars FROM decoded
"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_minhash_dedup": MINHASH_DEDUP,
    "op5_fingerprints": FINGERPRINTS,
    "op7_sharding": SHARDING,
    "op8_url_filter": URL_FILTER,
    "op10_decontamination": DECONTAMINATION,
    "op11_conversation_repair": CONVERSATIONS,
    "op12_collocations": COLLOCATIONS,
    "op13_html_text": HTML_TEXT,
}
