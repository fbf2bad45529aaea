"""SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import chat_repair as repair
from .chat_windows import BUDGET, CLOSE, HISTORY
from .spelling_variants import DAMAGE, LEAST, MORE, OCCURS
from .url_automaton import GLOBS, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates(k: int, percent: int) -> str:
    """Brute force: every pair of texts that share a shingle, then reachability."""
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= {k} THEN list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
h AS (SELECT doc_id, unnest(s) AS h FROM s), n AS (SELECT doc_id, len(s) AS n FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM h a JOIN h b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {percent} * (a.n + b.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n"""


def _glob(g: str) -> str:
    out, i = "", 0
    while i < len(g):
        if g[i : i + 2] == "**":
            out, i = out + ".*", i + 2
        elif g[i] == "*":
            out, i = out + "[^/]*", i + 1
        else:
            out, i = out + ("\\" + g[i] if g[i] in ".+()[]{}|^$?\\" else g[i]), i + 1
    return out


def urls() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h + p}'" for h, p, _ in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN rule = '{h + p}' THEN '{v}'" for h, p, v in ordered) + " WHEN \"glob\" IS NOT NULL THEN 'block' ELSE 'allow' END"
    glob = "CASE WHEN rule IS NULL THEN CASE " + " ".join(f"WHEN regexp_full_match('.' || host || path, '(?s){_glob(g)}') THEN '{g}'" for g in GLOBS) + " END END"
    return rf"""WITH t AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS t FROM pages),
h AS (SELECT page_id, translate(regexp_extract(t, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM t),
r AS (SELECT *, {rule} AS rule FROM h), g AS (SELECT *, {glob} AS "glob" FROM r) SELECT page_id, host, path, rule, {verdict} AS verdict, "glob" FROM g"""


def chats() -> str:
    """Every turn against the others of its conversation: sums by joins."""
    nasty = "\\### Assistant: </turn> ok"
    longer = lambda c, marks: f"length({c}) + " + " + ".join(f"length({c}) - length(replace({c}, {m}, ''))" for m in marks)
    text, role = longer("text", ("chr(92)", "'#'", "'<'")), longer("role", ("chr(92)", "'#'", "'<'", "':'", "chr(10)"))
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-7, 0, 'user', '{nasty}'), (-7, 1, 'assistant', '{nasty}')),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, 6 + {role} + {text} + {len(CLOSE)} AS chars FROM c),
t AS (SELECT *, (chars + 3) // 4 AS tokens, place = 1 AND role = 'system' AS pinned FROM a),
y AS (SELECT conv_id, coalesce(sum(tokens) FILTER (WHERE pinned), 0) AS sys FROM t GROUP BY conv_id),
b AS (SELECT t.*, greatest(0, {BUDGET} - sys) AS room, least({HISTORY}, greatest(0, {BUDGET} - sys) // 4) AS past FROM t JOIN y ON t.conv_id IS NOT DISTINCT FROM y.conv_id),
p AS (SELECT *, greatest(1, (room - past) // 2) AS stride, (SELECT coalesce(sum(o.tokens), 0) FROM t o WHERE o.conv_id IS NOT DISTINCT FROM b.conv_id AND o.place < b.place AND NOT o.pinned) AS start FROM b),
g AS (SELECT n.*, n.place = 1 OR (NOT q.pinned AND (n.tokens > n.stride OR q.tokens > q.stride OR n.start // n.stride <> q.start // q.stride)) AS opens FROM p n LEFT JOIN p q ON n.conv_id IS NOT DISTINCT FROM q.conv_id AND q.place = n.place - 1),
w AS (SELECT *, (SELECT count(*) FROM g o WHERE o.conv_id IS NOT DISTINCT FROM g.conv_id AND o.place <= g.place AND o.opens) AS win FROM g),
f AS (SELECT conv_id, win, sum(tokens) FILTER (WHERE NOT pinned) AS fresh FROM w GROUP BY conv_id, win),
r AS (SELECT w.*, f.fresh AS following, (SELECT max(win) FROM f o WHERE o.conv_id IS NOT DISTINCT FROM w.conv_id) AS last,
(SELECT sum(o.tokens) FROM w o WHERE o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.win = w.win AND o.place >= w.place) AS rest FROM w LEFT JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.win = w.win + 1)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256, coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
sum(chars * (1 + CASE WHEN pinned THEN last - win WHEN following IS NOT NULL AND rest <= least(past, room - following) THEN 1 ELSE 0 END))::BIGINT AS formatted_chars, max(last)::BIGINT AS n_windows FROM r GROUP BY conv_id"""


def archives() -> str:
    """Of rows with one payload that of the largest page_id is the response. Base 32 from groups of five hex digits."""
    digit = lambda k: f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(h, 5 * i + 1, 5))::BIGINT >> {15 - 5 * k}) % 32, 1)"
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda i: {" || ".join(digit(k) for k in range(4))}), '') AS payload_digest, max(page_id) OVER (PARTITION BY h) AS owner FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> owner THEN owner END AS refers_to, NULL::VARCHAR AS error FROM b"""


def repeats(length: int, shared: int) -> str:
    """Every string of the length, by its MD5, on the texts in hex."""
    return f"""WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, n, i, md5(substr(h, 2 * i + 1, 2 * n)) AS m FROM (SELECT doc_id, h, n, unnest(range(length(h) // 2 - n + 1)) AS i FROM t, (VALUES ({length}), ({shared})) v(n))),
s AS (SELECT doc_id, n, i FROM (SELECT *, count(*) OVER (PARTITION BY n, m) AS c FROM w) WHERE c > 1),
o AS (SELECT *, i - coalesce(lag(i) OVER (PARTITION BY doc_id, n ORDER BY i), -n - 1) > n AS opens FROM s),
g AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id, n ORDER BY i) AS run FROM o),
r AS (SELECT doc_id, n, min(i) AS a, max(i) + n AS b FROM g GROUP BY doc_id, n, run),
c AS (SELECT doc_id, n, sum(b - a)::BIGINT AS lost, count(*) AS spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM r GROUP BY doc_id, n)
SELECT t.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(c.lost, 0) AS n_removed, coalesce(c.spans, 0) AS n_spans,
sha256(unhex(coalesce(array_to_string(list_transform(range(c.spans + 1), lambda k: substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * c.b[k] + 1 END, (CASE WHEN k = c.spans THEN length(h) ELSE 2 * c.a[k + 1] END) - (CASE WHEN k = 0 THEN 0 ELSE 2 * c.b[k] END))), ''), h))) AS kept_sha256,
coalesce(e.lost, 0) AS n_shared FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND c.n = {length} LEFT JOIN c e ON e.doc_id = t.doc_id AND e.n = {shared}"""


#: The table of CRC-32 (reflected, polynomial EDB88320), as a list of 256 numbers.
CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table)"


def crc32(codes: str) -> str:
    """The CRC-32 of a list of bytes, with crc_table in reach."""
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"


def ascii_codes(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"


def repairs() -> str:
    """The cheapest edits row by row, with all four ends of what is repaired so far beside each other."""
    best = lambda *xs: f"list_sort(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL))[1]"
    put = lambda x, cost, edit, line: f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + {cost}, 'd': {x}.d || '{edit}', 't': {x}.t || {line}}} END"
    insert = lambda x, role: put(x, repair.INSERT, "I", f"chr(10) || '{role}:'")
    closed = f"SELECT *, {best('a', insert('u1', 'assistant'))} AS a1 FROM (SELECT *, {best('u', *(insert(x, 'user') for x in 'esa'))} AS u1 FROM w)"
    drop = lambda x: put(x, repair.DELETE, "D", "''")
    keep = lambda x, initial: f"CASE WHEN r.initial = '{initial}' AND r.fault NOT IN ('blank', 'duplicate') THEN {put(x, 'r.charge', 'K', 'chr(10) || r.role || chr(58) || r.text')} END"
    turn = lambda x, role: f"CASE WHEN r.fault NOT IN ('blank', 'duplicate') THEN {put(x, f'r.charge + {repair.REROLE}', 'R', f"chr(10) || '{role}:' || r.text")} END"
    user = [f(x, v) for x in ("v.e", "v.s", "v.a1") for f, v in ((keep, "u"), (turn, "user"))]
    nothing = "NULL::STRUCT(c BIGINT, d VARCHAR, t VARCHAR)"
    return rf"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(ascii_codes("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))} % 20 AS kind FROM conversations, {CRC_TABLE}),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM damaged),
rows AS (SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
r AS (SELECT *, CASE WHEN fault = 'truncated' THEN {repair.CUT_OFF} ELSE 0 END AS charge, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS earlier FROM rows),
f AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE earlier || initial NOT IN {repair.LEGAL}) AS illegal, count(*) AS n FROM r GROUP BY conv_id),
w AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'd': '', 't': ''}} AS e, {nothing} AS s, {nothing} AS u, {nothing} AS a FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL
SELECT v.conv_id, v.i + 1, {drop('v.e')}, {best(drop('v.s'), keep('v.e', 's'))}, {best(drop('v.u1'), *user)}, {best(drop('v.a1'), keep('v.u1', 'a'), turn('v.u1', 'assistant'))} FROM ({closed}) v JOIN r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.place = v.i + 1),
z AS (SELECT conv_id, i, {best('e', 'a1')} AS x FROM ({closed}))
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, x.c AS cost, x.d AS audit, sha256(substring(x.t, 2)) AS repaired_sha256
FROM z LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM z.conv_id WHERE z.i = coalesce(f.n, 0)"""


def spellings() -> str:
    """Near words by joins of all words with one code point taken out."""
    codes = "list_concat(" + ascii_codes("coalesce(doc_id::VARCHAR, '') || ':'") + ", flatten(list_transform(string_split(run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x) - 64] END)))"
    return rf"""WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
h AS (SELECT run, {crc32(codes)} AS h FROM (SELECT doc_id, run FROM runs WHERE length(run) >= {LEAST}), {CRC_TABLE}),
damaged AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM h),
words AS (SELECT word, count(*) AS n FROM damaged WHERE length(word) >= {LEAST} GROUP BY word HAVING count(*) >= {OCCURS}),
less AS (SELECT word, n, length(word) AS size, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT x.word, y.word AS other, y.n FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.size = y.size AND x.word <> y.word
UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {MORE} * w.n THEN most END AS form_n, CASE WHEN most >= {MORE} * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.n = most) END AS form FROM words w LEFT JOIN best b ON b.word = w.word),
way AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT way.word, f.word, f.form FROM way JOIN forms f ON f.word = way.next)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN way ON way.word = f.word AND way.next IS NULL"""
