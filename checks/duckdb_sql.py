"""Oracle SQL for DuckDB, written apart from the Spark operators.

Choices are made with ``row_number`` where Spark uses ``min_by``, boards are
unnested into squares where Spark uses patterns, attacks are joins along rays,
and texts are token windows where Spark extracts by regular expression.
"""

from __future__ import annotations

from checks import tables as T

_NAMES = {"wide": "HUGEINT", "text": "VARCHAR"} | {
    t: t for t in ("orders", "lineitem", "documents", "corpus")
}


_CTES: dict[str, tuple[list[str], str]] = {}


def _define(name: str, needs: list[str], body: str) -> None:
    _CTES[name] = (needs, f"{name} AS ({body})")


def _query(needs: list[str], body: str) -> str:
    """``WITH`` every needed table, each after what it needs itself."""
    done: list[str] = []

    def add(name: str) -> None:
        if name not in done:
            for n in _CTES[name][0]:
                add(n)
            done.append(name)

    for n in needs:
        add(n)
    return ("WITH " + ",\n".join(_CTES[n][1] for n in done) + "\n" if done else "") + body


_define("corpus", [], T.CORPUS_SQL)
for _name, _needs, _sql in [
    ("keyed", ["corpus"], T.KEYED_SQL),
    ("entries", [], T.ENTRIES_SQL),
    ("flat", ["corpus"], T.FLAT_SQL),
    ("made", [], T.POSITIONS_SQL),
    ("docs", ["corpus"], T.DOCS_SQL),
]:
    _define(_name, _needs, _sql.format(**_NAMES))

_define(
    "evals",
    ["entries"],
    "SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord FROM entries",
)
_define(
    "best_first",
    ["evals"],
    """SELECT row_id, CAST(cp AS INT) AS eval, CAST(mate AS INT) AS mate, CAST(depth AS INT) AS depth,
       nullif(split_part(trim(line), ' ', 1), '') AS first_move
       FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY depth DESC, ord) AS rn
             FROM evals WHERE NOT empty_pvs) WHERE rn = 1""",
)
_define(
    "best_last",
    ["evals"],
    """SELECT row_id, CAST(cp AS INT) AS eval, CAST(mate AS INT) AS mate, CAST(depth AS INT) AS depth
       FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY depth DESC, ord DESC) AS rn
             FROM evals) WHERE rn = 1 AND NOT empty_pvs""",
)
_define(
    "simplified",
    ["keyed", "best_first"],
    """SELECT zobr64, eval, mate, depth, fen, first_move FROM (
         SELECT *, row_number() OVER (PARTITION BY zobr64, dk ORDER BY depth DESC, row_id) AS rn FROM (
           SELECT *, CASE WHEN len(string_split(fen, ' ')) >= 4
             THEN split_part(fen, ' ', 1) || ' ' || split_part(fen, ' ', 2) || ' ' || split_part(fen, ' ', 4)
             ELSE 'raw:' || fen END AS dk
           FROM keyed JOIN best_first USING (row_id))) WHERE rn = 1""",
)

_BITS = (
    "CASE WHEN zobr64 > 9223372036854775807 THEN CAST(CAST(zobr64 AS HUGEINT) - 18446744073709551616 AS BIGINT)"
    " ELSE CAST(zobr64 AS BIGINT) END"
)
_KHEX = "lpad(hex(CAST(zobr64 AS UBIGINT)), 16, '0')"
_ZTEXT = "CAST(zobr64 AS VARCHAR) AS zobr64"


# --- compact encoding -----------------------------------------------------

def _boards(source: str) -> None:
    """Fields, squares and first failing check per distinct text of a table."""
    s = source
    _define(
        f"fld_{s}",
        [s],
        f"""SELECT row_number() OVER (ORDER BY fen) AS id, fen, string_split_regex(trim(fen), '\\s+') AS p
            FROM (SELECT DISTINCT fen FROM {s})""",
    )
    _define(
        f"rank_{s}",
        [f"fld_{s}"],
        f"""SELECT id, unnest(string_split(p[1], '/')) AS txt,
            generate_subscripts(string_split(p[1], '/'), 1) AS i FROM fld_{s}""",
    )
    _define(
        f"char_{s}",
        [f"rank_{s}"],
        f"""SELECT id, i, unnest(string_split(txt, '')) AS c,
            generate_subscripts(string_split(txt, ''), 1) AS j FROM rank_{s}""",
    )
    _define(
        f"full_{s}",
        [f"char_{s}"],
        f"""SELECT id, i, string_agg(CASE WHEN c BETWEEN '1' AND '8' THEN repeat('.', TRY_CAST(c AS INT)) ELSE c END,
                                     '' ORDER BY j) AS s,
                   bool_and(contains('PNBRQKpnbrqk12345678', c)) AS ok
            FROM char_{s} GROUP BY id, i""",
    )
    _define(
        f"b64_{s}",
        [f"full_{s}"],
        f"""SELECT id, string_agg(s, '' ORDER BY i DESC) AS b64,
                   bool_and(ok AND length(s) = 8) AND count(*) = 8 AS ok
            FROM full_{s} GROUP BY id""",
    )
    _define(
        f"chk_{s}",
        [f"fld_{s}", f"b64_{s}"],
        f"""SELECT *, CASE WHEN error = 'castling' THEN substr(translate(p[3], 'KQkq', ''), 1, 1) END AS letter
            FROM (SELECT id, fen, p, b64, ok,
              CASE WHEN len(p) < 4 THEN 'fields' WHEN NOT ok THEN 'board'
                   WHEN p[2] NOT IN ('w', 'b') THEN 'side'
                   WHEN p[3] <> '-' AND translate(p[3], 'KQkq', '') <> '' THEN 'castling'
                   WHEN p[4] <> '-' AND NOT (length(p[4]) = 2 AND contains('abcdefgh', substr(p[4], 1, 1))
                        AND contains('12345678', substr(p[4], 2, 1))) THEN 'ep' END AS error
            FROM fld_{s} JOIN b64_{s} USING (id))""",
    )


for _s in ("keyed", "flat", "simplified", "made"):
    _boards(_s)


def _square(text: str, start: int) -> str:
    return f"((ascii(substr({text}, {start + 1}, 1)) - 49) * 8 + ascii(substr({text}, {start}, 1)) - 97)"


_PROMO = "CASE WHEN length(first_move) = 5 THEN strpos('nbrq', lower(substr(first_move, 5, 1))) ELSE 0 END"
_KIND = "CASE WHEN mate IS NOT NULL THEN 1 ELSE 0 END"
_NULL_MOVE = "first_move IS NULL OR first_move = '0000'"
_GOOD_MOVE = "regexp_full_match(first_move, '([a-h][1-8]){2}[nbrqNBRQ]?')"
_META = f"""CASE WHEN {_NULL_MOVE} THEN {_KIND} * 32768
  WHEN {_GOOD_MOVE} THEN {_square("first_move", 1)} + {_square("first_move", 3)} * 64 + ({_PROMO}) * 4096
       + {_KIND} * 32768 END"""
_SCORE = """CASE WHEN mate IS NOT NULL THEN greatest(least(mate, 32767), -32768)
  WHEN eval IS NOT NULL THEN greatest(least(eval, 32767), -32768) END"""
_DEPTH = "greatest(least(depth, 255), 0)"


def _encoded(source: str) -> None:
    """Rows of a table with error and entry hex."""
    s = source
    _define(
        f"nib_{s}",
        [f"chk_{s}"],
        f"""SELECT id, string_agg(printf('%02X', strpos('PNBRQKpnbrqk', substr(b64, 2 * i + 1, 1))
                     + 16 * strpos('PNBRQKpnbrqk', substr(b64, 2 * i + 2, 1))), '' ORDER BY i) AS squares
            FROM chk_{s}, (SELECT unnest(range(32)) AS i) WHERE error IS NULL GROUP BY id""",
    )
    _define(
        f"b34_{s}",
        [f"nib_{s}"],
        f"""SELECT id, squares || printf('%02X', CASE WHEN p[2] = 'b' THEN 1 ELSE 0 END
                     + CASE WHEN contains(p[3], 'K') THEN 2 ELSE 0 END + CASE WHEN contains(p[3], 'Q') THEN 4 ELSE 0 END
                     + CASE WHEN contains(p[3], 'k') THEN 8 ELSE 0 END + CASE WHEN contains(p[3], 'q') THEN 16 ELSE 0 END)
                 || printf('%02X', CASE WHEN p[4] = '-' THEN 255 ELSE {_square("p[4]", 1)} END) AS board34
            FROM chk_{s} JOIN nib_{s} USING (id)""",
    )
    _define(
        f"enc_{s}",
        [s, f"chk_{s}", f"b34_{s}"],
        f"""SELECT t.*, c.letter AS fen_letter, b.board34, score, meta,
              CASE WHEN t.eval IS NULL AND t.mate IS NULL THEN 'score'
                   WHEN NOT ({_NULL_MOVE}) AND NOT {_GOOD_MOVE} THEN 'move' ELSE c.error END AS encode_error
            FROM (SELECT *, {_SCORE} AS score, {_META} AS meta FROM {s}) t
            JOIN chk_{s} c ON c.fen = t.fen LEFT JOIN b34_{s} b ON b.id = c.id""",
    )
    _define(
        f"ent_{s}",
        [f"enc_{s}"],
        f"""SELECT *, printf('%02X%02X%02X%02X%02X', (score + 65536) % 256, ((score + 65536) // 256) % 256, {_DEPTH},
                 meta % 256, meta // 256) || board34 AS entry
            FROM enc_{s} WHERE encode_error IS NULL""",
    )


for _s in ("flat", "simplified"):
    _encoded(_s)


# --- free text ------------------------------------------------------------

_define(
    "tok",
    ["docs"],
    """SELECT doc_id, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM
       (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS l FROM docs)""",
)
_define(
    "ahead",
    ["tok"],
    """SELECT doc_id, i, t, """
    + ", ".join(f"lead(t, {n}) OVER w AS t{n}" for n in range(1, 6))
    + """ FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY i)""",
)
_define(
    "marked",
    ["ahead"],
    """SELECT *, CASE WHEN t = 'zobr64:' AND regexp_full_match(t1, '\\+?[0-9]+')
                       AND TRY_CAST(ltrim(t1, '+') AS HUGEINT) <= 18446744073709551615
                  THEN CAST(TRY_CAST(ltrim(t1, '+') AS HUGEINT) AS VARCHAR) END AS header,
         contains(t, '/') AND t2 IS NOT NULL AND t1 IN ('w', 'b')
         AND (t2 = '-' OR (regexp_full_match(t2, '[KQkq]{1,4}') AND len(list_distinct(string_split(t2, ''))) = length(t2)))
         AND (t3 = '-' OR regexp_full_match(t3, '[a-h][1-8]'))
         AND len(string_split(t, '/')) = 8
         AND len(list_filter(string_split(t, '/'), lambda r: regexp_full_match(r, '[PNBRQKpnbrqk1-8]+')
               AND list_sum(list_transform(string_split(r, ''), lambda c: coalesce(TRY_CAST(c AS INT), 1))) = 8)) = 8 AS hit
       FROM ahead""",
)
_define(
    "found",
    ["marked"],
    """SELECT doc_id, i, zobr64, t || ' ' || t1 || ' ' || t2 || ' ' || t3 ||
         CASE WHEN regexp_full_match(t4, '[0-9]+') AND regexp_full_match(t5, '[0-9]+') THEN ' ' || t4 || ' ' || t5
              ELSE '' END AS fen
       FROM (SELECT *, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS zobr64 FROM marked) WHERE hit""",
)

# The same over whole files, each the texts of one remainder in order.
_define("docs_file", ["docs"], "SELECT doc_id % 4 AS doc_id, string_agg(text, chr(10) ORDER BY doc_id) AS text FROM docs GROUP BY 1")
for _name in ("tok", "ahead", "marked", "found"):
    _needs, _sql = _CTES[_name]
    _body = _sql[len(f"{_name} AS (") : -1]
    for _need in _needs:
        _body = _body.replace(f"FROM {_need}", f"FROM {_need}_file")
    _define(f"{_name}_file", [f"{n}_file" for n in _needs], _body)

# --- chess geometry -------------------------------------------------------

_GEOMETRY: list[tuple[str, list[str], str]] = []


def _geometry(name: str, needs: list[str], body: str) -> None:
    """A table of the position rules; ``@`` stands for the source it is about."""
    _GEOMETRY.append((name, needs, body))


_define(
    "constants",
    [],
    """SELECT s, CAST('0x' || substr(md5('slot:' || s), 1, 16) AS UBIGINT) AS hi,
         CAST('0x' || substr(md5('slot:' || s), 17, 16) AS UBIGINT) AS lo FROM (SELECT unnest(range(781)) AS s)""",
)
_COUNT = "(length(b64) - length(replace(b64, '{0}', '')))"


def _material(letters: str) -> str:
    p, n, b, r, q, k = letters
    light = f"(SELECT count(*) FROM sq@ WHERE sq@.id = built@.id AND c = '{b}' AND (r + f) % 2 = 1)"
    dark = f"(SELECT count(*) FROM sq@ WHERE sq@.id = built@.id AND c = '{b}' AND (r + f) % 2 = 0)"
    c = _COUNT.format
    promoted = " + ".join(f"greatest({x}, 0)" for x in (f"{c(n)} - 2", f"{light} - 1", f"{dark} - 1", f"{c(r)} - 2", f"{c(q)} - 1"))
    men = " + ".join(c(x) for x in letters)
    return f"({men} > 16 OR {c(p)} > 8 OR {promoted} > 8 - {c(p)})"


_geometry(
    "pos@",
    ["fld@", "b64@"],
    """SELECT id, fen, b64, p[1] AS board, CASE WHEN len(p) < 2 THEN 'w' ELSE p[2] END AS side,
         coalesce(p[3], '-') AS castling, coalesce(p[4], '-') AS ep,
         CASE WHEN len(p) > 6 OR (len(p) > 4 AND NOT regexp_full_match(p[5], '[0-9]+'))
                OR (len(p) > 5 AND NOT regexp_full_match(p[6], '[0-9]+')) THEN 'fields'
              WHEN NOT ok THEN 'board'
              WHEN len(p) >= 2 AND p[2] NOT IN ('w', 'b') THEN 'side'
              WHEN len(p) >= 3 AND p[3] <> '-' AND translate(p[3], 'KQkqABCDEFGHabcdefgh', '') <> '' THEN 'castling'
              WHEN len(p) >= 4 AND p[4] <> '-' AND NOT regexp_full_match(p[4], '[a-h][1-8]') THEN 'ep'
         END AS syntax
       FROM fld@ JOIN b64@ USING (id)""",
)
_geometry(
    "sq@",
    ["pos@"],
    """SELECT id, i, i // 8 AS r, i % 8 AS f, substr(b64, i + 1, 1) AS c
       FROM pos@, (SELECT CAST(unnest(range(64)) AS INT) AS i) WHERE syntax IS NULL""",
)
_geometry(
    "epgeo@",
    ["pos@"],
    """SELECT *, er = CASE WHEN side = 'w' THEN 5 ELSE 2 END AND substr(b64, er * 8 + ef + 1, 1) = '.'
         AND substr(b64, (er + d) * 8 + ef + 1, 1) = '.'
         AND substr(b64, (er - d) * 8 + ef + 1, 1) = CASE WHEN side = 'w' THEN 'p' ELSE 'P' END AS fits
       FROM (SELECT *, ascii(substr(ep, 1, 1)) - 97 AS ef, ascii(substr(ep, 2, 1)) - 49 AS er,
                    CASE WHEN side = 'w' THEN 1 ELSE -1 END AS d
             FROM pos@ WHERE syntax IS NULL AND ep <> '-')""",
)
_geometry(
    "cap@",
    ["epgeo@"],
    """SELECT id, side, x, (er - d) * 8 + ef + x AS own_at, (er - d) * 8 + ef AS enemy_at, er * 8 + ef AS ep_at,
         CASE WHEN side = 'w' THEN 'P' ELSE 'p' END AS own
       FROM epgeo@, (VALUES (-1), (1)) AS t(x)
       WHERE fits AND ef + x BETWEEN 0 AND 7
         AND substr(b64, (er - d) * 8 + ef + x + 1, 1) = CASE WHEN side = 'w' THEN 'P' ELSE 'p' END""",
)
_geometry(
    "men@",
    ["sq@", "cap@"],
    """SELECT * FROM (
         SELECT id, 0 AS v, r, f, c FROM sq@
         UNION ALL
         SELECT s.id, x AS v, r, f, CASE WHEN i IN (own_at, enemy_at) THEN '.' WHEN i = ep_at THEN own ELSE c END
         FROM sq@ s JOIN cap@ ON cap@.id = s.id) WHERE c <> '.'""",
)
_geometry("kings@", ["men@"], "SELECT id, v, r, f, CASE WHEN c = 'K' THEN 'w' ELSE 'b' END AS color FROM men@ WHERE c IN ('K', 'k')")
_geometry(
    "slides@",
    ["kings@"],
    """SELECT id, v, color, dr, df FROM (
         SELECT k.id, k.v, k.color, dr, df, arg_min(m.c, n) AS c
         FROM kings@ k CROSS JOIN (SELECT a.x AS dr, b.x AS df FROM (VALUES (-1), (0), (1)) a(x), (VALUES (-1), (0), (1)) b(x)
                                  WHERE a.x <> 0 OR b.x <> 0)
              CROSS JOIN (SELECT CAST(unnest(range(1, 8)) AS INT) AS n)
              JOIN men@ m ON m.id = k.id AND m.v = k.v AND m.r = k.r + dr * n AND m.f = k.f + df * n
         GROUP BY k.id, k.v, k.color, k.r, k.f, dr, df)
       WHERE (CASE WHEN color = 'w' THEN c = lower(c) ELSE c = upper(c) END)
         AND lower(c) IN ('q', CASE WHEN dr = 0 OR df = 0 THEN 'r' ELSE 'b' END)""",
)
_geometry(
    "jumps@",
    ["kings@"],
    """SELECT k.id, k.v, k.color FROM kings@ k JOIN men@ m ON m.id = k.id AND m.v = k.v
       WHERE (m.c = CASE WHEN color = 'w' THEN 'n' ELSE 'N' END AND abs(m.r - k.r) * abs(m.f - k.f) = 2)
          OR (m.c = CASE WHEN color = 'w' THEN 'k' ELSE 'K' END AND greatest(abs(m.r - k.r), abs(m.f - k.f)) = 1)
          OR (m.c = CASE WHEN color = 'w' THEN 'p' ELSE 'P' END AND abs(m.f - k.f) = 1
              AND m.r - k.r = CASE WHEN color = 'w' THEN 1 ELSE -1 END)""",
)
_geometry(
    "checks@",
    ["slides@", "jumps@"],
    """SELECT id, v, color, count(*) AS n FROM
       (SELECT id, v, color FROM slides@ UNION ALL SELECT id, v, color FROM jumps@) GROUP BY id, v, color""",
)
_geometry(
    "legal_ep@",
    ["cap@", "checks@"],
    """SELECT DISTINCT cap@.id FROM cap@ LEFT JOIN checks@ k ON k.id = cap@.id AND k.v = cap@.x AND k.color = cap@.side
       WHERE k.id IS NULL""",
)
_geometry(
    "built@",
    ["pos@", "sq@", "checks@", "legal_ep@"],
    """SELECT pos@.*, legal_ep@.id IS NOT NULL AS ep_legal,
         CASE WHEN syntax IS NULL THEN
           CASE WHEN length(b64) - length(replace(b64, 'K', '')) <> 1 OR length(b64) - length(replace(b64, 'k', '')) <> 1
                  THEN 'kings'
                WHEN contains(lower(substr(b64, 1, 8) || substr(b64, 57, 8)), 'p') THEN 'pawns'
                WHEN EXISTS (SELECT 1 FROM checks@ k WHERE k.id = pos@.id AND k.v = 0 AND k.color <> pos@.side)
                  THEN 'opposite check' END END AS bad,
         substr(b64, 5, 1) = 'K' AND substr(b64, 8, 1) = 'R' AS wk, substr(b64, 5, 1) = 'K' AND substr(b64, 1, 1) = 'R' AS wq,
         substr(b64, 61, 1) = 'k' AND substr(b64, 64, 1) = 'r' AS bk, substr(b64, 61, 1) = 'k' AND substr(b64, 57, 1) = 'r' AS bq
       FROM pos@ LEFT JOIN legal_ep@ USING (id)""",
)
_geometry(
    "terms@",
    ["built@", "sq@"],
    """SELECT id, 64 * (strpos('pPnNbBrRqQkK', c) - 1) + i AS s FROM sq@ WHERE c <> '.'
       UNION ALL SELECT id, 768 FROM built@ WHERE wk AND regexp_matches(castling, '[KH]')
       UNION ALL SELECT id, 769 FROM built@ WHERE wq AND regexp_matches(castling, '[QA]')
       UNION ALL SELECT id, 770 FROM built@ WHERE bk AND regexp_matches(castling, '[kh]')
       UNION ALL SELECT id, 771 FROM built@ WHERE bq AND regexp_matches(castling, '[qa]')
       UNION ALL SELECT id, 772 + ascii(ep) - 97 FROM built@ WHERE ep_legal
       UNION ALL SELECT id, 780 FROM built@ WHERE side = 'w'""",
)
_geometry(
    "keys@",
    ["terms@", "constants"],
    "SELECT id, bit_xor(hi) AS hi, bit_xor(lo) AS lo FROM terms@ JOIN constants USING (s) GROUP BY id",
)
_geometry(
    "flags@",
    ["built@", "sq@", "slides@", "checks@", "epgeo@"],
    f"""SELECT *, e_castling AND NOT (e_ep OR e_check OR e_material) AS masked FROM (
         SELECT id, board = '{T._START}' AND side = 'b' AS s_start, syntax IS NOT NULL AS s_syntax, bad IS NOT NULL AS s_bad,
           ok AND castling <> '-' AND (regexp_matches(castling, '[B-Gb-g]') OR (regexp_matches(castling, '[KH]') AND NOT wk)
             OR (regexp_matches(castling, '[QA]') AND NOT wq) OR (regexp_matches(castling, '[kh]') AND NOT bk)
             OR (regexp_matches(castling, '[qa]') AND NOT bq)) AS e_castling,
           ok AND EXISTS (SELECT 1 FROM epgeo@ g WHERE g.id = built@.id AND NOT fits) AS e_ep,
           ok AND (EXISTS (SELECT 1 FROM checks@ k WHERE k.id = built@.id AND k.v = 0 AND k.color = side AND k.n >= 3)
             OR EXISTS (SELECT 1 FROM slides@ a JOIN slides@ b ON a.id = b.id AND a.v = b.v AND a.color = b.color
                          AND a.dr = -b.dr AND a.df = -b.df
                        WHERE a.id = built@.id AND a.v = 0 AND a.color = side)) AS e_check,
           ok AND ({_material("PNBRQK")} OR {_material("pnbrqk")}) AS e_material,
           ok AND castling <> '-' AND NOT (translate(castling, 'KQkq', '') = '' AND (wk OR NOT contains(castling, 'K'))
             AND (wq OR NOT contains(castling, 'Q')) AND (bk OR NOT contains(castling, 'k'))
             AND (bq OR NOT contains(castling, 'q'))) AS x_castling,
           ok AND ep <> '-' AND NOT ep_legal AS x_ep
         FROM (SELECT *, syntax IS NULL AND bad IS NULL AS ok FROM built@) built@)""",
)

for _s in ("made", "found"):
    if _s != "made":
        _boards(_s)
    for _name, _needs, _body in _GEOMETRY:
        _define(_name.replace("@", f"_{_s}"), [n.replace("@", f"_{_s}") for n in _needs], _body.replace("@", f"_{_s}"))


# The label list of one text from its flags.
_REPORTED = """coalesce(nullif(concat_ws('; ',
             CASE WHEN s_start THEN 'impossible side to move for standard starting board' END,
             CASE WHEN s_syntax THEN 'invalid fen syntax' END,
             CASE WHEN e_material THEN 'too much material' WHEN e_check THEN 'impossible check state'
                  WHEN e_ep THEN 'invalid en-passant square' WHEN e_castling THEN 'invalid castling rights' END,
             CASE WHEN x_castling AND NOT masked THEN 'castling not possible from this position' END,
             CASE WHEN x_ep THEN 'en-passant not possible from this position' END,
             CASE WHEN s_bad THEN 'unrecoverable position error' END), ''), 'OK') AS reported"""


_define(
    "repeated",
    ["keyed"],
    "SELECT zobr64, count(*) AS rows FROM keyed GROUP BY zobr64 HAVING count(*) > 1",
)
_PROFILE = """SELECT zobr64, count(*) AS rows, count(DISTINCT fen) AS fen_unique,
  count(DISTINCT split_part(fen, ' ', 1)) AS board_unique,
  count(DISTINCT split_part(fen, ' ', 2)) AS turn_unique,
  count(DISTINCT split_part(fen, ' ', 3)) AS castling_unique,
  count(DISTINCT split_part(fen, ' ', 4)) AS ep_unique
  FROM keyed GROUP BY zobr64 HAVING count(*) > 1"""
_define(
    "profile",
    ["keyed"],
    f"""SELECT *, board_unique = 1 AND turn_unique = 1 AND ep_unique = 1 AND castling_unique > 1 AS castle_rights_only
        FROM ({_PROFILE})""",
)
_TYPE = "CASE WHEN castle_rights_only THEN 'castle_rights_only' ELSE 'other_fen_difference' END"
_LINE = "row_id, line_no, part, supp"
_LETTERS = """SELECT letter, rows FROM found_letters
  UNION ALL SELECT '-', 0 WHERE NOT EXISTS (SELECT 1 FROM found_letters)"""

_define(
    "moved",
    ["chk_keyed"],
    """SELECT o_orderkey, fen, letter, count(*) OVER () AS total
       FROM orders JOIN corpus ON pos_id = o_custkey % 47 JOIN chk_keyed USING (fen)""",
)

_LATEST = f"""SELECT {_BITS} AS zobr64, eval, mate, depth, fen, first_move, n - 1 AS skipped FROM (
  SELECT *, row_number() OVER (PARTITION BY zobr64 ORDER BY fen DESC) AS rn,
         count(*) OVER (PARTITION BY zobr64) AS n FROM simplified) WHERE rn = 1"""

# Input lines over made-up boards: five lines to a board, depths cut at 20.
_define(
    "legal",
    ["made", "built_made", "keys_made"],
    """SELECT board, arg_min(fen, row_id) AS fen, arg_min(hi, row_id) AS hi FROM (
         SELECT row_id - row_id % 5 AS board, row_id, fen, hi
         FROM made JOIN built_made USING (fen) JOIN keys_made USING (id) WHERE syntax IS NULL AND bad IS NULL)
       GROUP BY board""",
)
_define(
    "capped_last",
    ["evals"],
    """SELECT row_id, CAST(cp AS INT) AS eval, CAST(mate AS INT) AS mate, CAST(d AS INT) AS depth
       FROM (SELECT *, least(depth, 20) AS d,
               row_number() OVER (PARTITION BY row_id ORDER BY least(depth, 20) DESC, ord DESC) AS rn FROM evals)
       WHERE rn = 1 AND NOT empty_pvs""",
)
_define(
    "lines",
    ["keyed", "legal", "capped_last"],
    """SELECT k.row_id, l.fen, l.hi AS zobr64, c.eval, c.mate, c.depth
       FROM keyed k JOIN legal l ON l.board = k.row_id - k.row_id % 5 LEFT JOIN capped_last c ON c.row_id = k.row_id""",
)
_JSON = """'{"eval":' || coalesce(CAST(eval AS VARCHAR), 'null') || ',"mate":' || coalesce(CAST(mate AS VARCHAR), 'null')
  || ',"depth":' || depth || ',"fen":"' || fen || '"}' AS v"""

ORACLES: dict[str, str] = {
    "simplify_counters": _query(
        ["keyed", "best_first", "simplified"],
        """SELECT count(*) AS input_rows, count(*) - count(depth) AS skipped_rows_without_eval,
             (SELECT count(*) FROM simplified) AS output_rows FROM keyed LEFT JOIN best_first USING (row_id)""",
    ),
    "build_kv_counters": _query(
        ["enc_flat"],
        """SELECT count(*) AS input_rows, count(encode_error) AS skipped_rows,
             count(DISTINCT zobr64) FILTER (encode_error IS NULL) AS written_keys FROM enc_flat""",
    ),
    "build_kv_letters": _query(
        ["enc_flat"],
        f"""SELECT * FROM (WITH found_letters AS (SELECT fen_letter AS letter, count(*) AS rows FROM enc_flat
              WHERE encode_error = 'castling' GROUP BY fen_letter) {_LETTERS})""",
    ),
    "build_deepest_job": _query(
        ["lines"],
        f"""SELECT row_number() OVER (ORDER BY k) - 1 AS ord, k, v FROM (
              SELECT {_KHEX} AS k, {_JSON}
              FROM (SELECT *, row_number() OVER (PARTITION BY zobr64 ORDER BY depth DESC, row_id) AS rn
                    FROM lines WHERE depth IS NOT NULL) WHERE rn = 1)""",
    ),
    "build_deepest_counters": _query(
        ["lines"],
        """SELECT count(*) + count(*) FILTER (row_id % 50 = 7) AS lines, count(depth) AS rows_with_eval,
             count(*) - count(depth) AS rows_missing_eval,
             count(*) FILTER (depth > before) AS updated_keys, count(*) FILTER (depth <= before) AS kept_existing_keys,
             count(DISTINCT zobr64) FILTER (depth IS NOT NULL) AS written_keys
           FROM (SELECT *, coalesce(max(depth) OVER (PARTITION BY zobr64 ORDER BY row_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before FROM lines)""",
    ),
    "lookup_latest": _query(
        ["simplified"], f"SELECT * EXCLUDE (skipped) FROM ({_LATEST}) WHERE zobr64 = 11400714819323198485 - 18446744073709551616"
    ),
    "ingest_job": _query(
        ["keyed", "evals"],
        """SELECT any_value(fen) AS fen, coalesce(string_agg(knodes || ':' || depth || ':' ||
             CASE WHEN empty_pvs THEN '' ELSE coalesce(CAST(cp AS VARCHAR), 'NULL') || '/'
               || coalesce(CAST(mate AS VARCHAR), 'NULL') || '/' || line END, '|' ORDER BY ord), '') AS entries
           FROM keyed LEFT JOIN evals USING (row_id) GROUP BY row_id""",
    ),
    "read_scores_json": _query(
        ["keyed", "evals"],
        """SELECT any_value(fen) AS fen, coalesce(string_agg(depth || ':' ||
             CASE WHEN empty_pvs THEN '' ELSE coalesce(CAST(cp AS VARCHAR), 'NULL') || '/'
               || coalesce(CAST(mate AS VARCHAR), 'NULL') END, '|' ORDER BY ord), '') AS entries
           FROM keyed LEFT JOIN evals USING (row_id) GROUP BY row_id""",
    ),
    "add_position_key_job": _query(
        ["made", "built_made", "keys_made"],
        """SELECT row_id, CAST(hi AS VARCHAR) AS zobr64, lpad(hex(hi), 16, '0') || lpad(hex(lo), 16, '0') AS zobr128
           FROM made JOIN built_made USING (fen) JOIN keys_made USING (id) WHERE syntax IS NULL AND bad IS NULL""",
    ),
    "scan_castling_job": _query(
        ["moved"],
        f"""SELECT * FROM (WITH head AS (SELECT * FROM moved WHERE o_orderkey < ceil(total * 0.25)),
              found_letters AS (SELECT letter, count(*) AS rows FROM head WHERE letter IS NOT NULL GROUP BY letter)
              SELECT *, (SELECT count(*) FROM head) AS sampled_rows, (SELECT count(letter) FROM head) AS failed_rows
              FROM ({_LETTERS}))""",
    ),
    "read_eval_json": _query(
        ["keyed", "evals"],
        """SELECT any_value(fen) AS fen, coalesce(string_agg(knodes || ':' || depth || ':' ||
             CASE WHEN empty_pvs THEN '' ELSE coalesce(CAST(cp AS VARCHAR), 'NULL') || '/'
               || coalesce(CAST(mate AS VARCHAR), 'NULL') || '/' || line END, '|' ORDER BY ord), '') AS entries
           FROM keyed LEFT JOIN evals USING (row_id) GROUP BY row_id""",
    ),
    "sort_table_job": _query(
        ["keyed"], "SELECT row_number() OVER (ORDER BY zobr64) - 1 AS ord, CAST(zobr64 AS VARCHAR) AS zobr64 FROM keyed"
    ),
    "simplify_job": _query(
        ["simplified"],
        """SELECT row_number() OVER (ORDER BY s.zobr64, fen) - 1 AS ord, CAST(s.zobr64 AS VARCHAR) AS zobr64,
             eval, mate, depth, fen, first_move FROM simplified s""",
    ),
    "build_latest_job": _query(["simplified"], f"SELECT * EXCLUDE (skipped) FROM ({_LATEST})"),
    "build_kv_job": _query(
        ["ent_simplified"],
        f"""SELECT row_number() OVER (ORDER BY k) - 1 AS ord, k, v FROM (
              SELECT {_KHEX} AS k, printf('%02X', count(*)) || string_agg(entry, '' ORDER BY fen) AS v
              FROM ent_simplified GROUP BY zobr64)""",
    ),
    "best_eval_first": _query(["best_first"], "SELECT row_id, eval, mate, depth, first_move FROM best_first"),
    "best_eval_last": _query(["best_last"], "SELECT row_id, eval, mate, depth FROM best_last"),
    "first_token": _query(
        ["entries"],
        """SELECT row_id, l_linenumber, l_partkey, l_suppkey, nullif(split_part(trim(line), ' ', 1), '') AS move
           FROM entries""",
    ),
    "fen_fields": _query(
        ["made"],
        """SELECT row_id, CAST(len(p) AS INT) AS n_fields, p[1] AS board, p[2] AS side, coalesce(p[3], '-') AS castling,
           coalesce(p[4], '-') AS ep FROM (SELECT row_id, string_split(fen, ' ') AS p FROM made)""",
    ),
    "dedupe_key": _query(
        ["made"],
        """SELECT row_id, CASE WHEN len(p) < 4 THEN 'raw:' || fen ELSE array_to_string([p[1], p[2], p[4]], ' ') END AS dedupe_key
           FROM (SELECT row_id, fen, string_split(fen, ' ') AS p FROM made)""",
    ),
    "board64": _query(
        ["keyed", "chk_keyed"],
        """SELECT row_id, CASE WHEN ok THEN b64 END AS board64, error AS fen_error
           FROM keyed JOIN chk_keyed USING (fen)""",
    ),
    "simplify_positions": _query(
        ["simplified"], f"SELECT {_ZTEXT}, eval, mate, depth, fen, first_move FROM simplified"
    ),
    "latest_per_key": _query(["simplified"], _LATEST),
    "deepest_per_key": _query(
        ["keyed", "best_last"],
        f"""SELECT {_KHEX} AS k, '{{"eval":' || coalesce(CAST(eval AS VARCHAR), 'null') || ',"mate":'
              || coalesce(CAST(mate AS VARCHAR), 'null') || ',"depth":' || depth || ',"fen":"' || fen || '"}}' AS v
            FROM (SELECT *, row_number() OVER (PARTITION BY zobr64 ORDER BY depth DESC, row_id) AS rn
                  FROM keyed JOIN best_last USING (row_id)) WHERE rn = 1""",
    ),
    "upsert_metrics": _query(
        ["keyed", "best_last"],
        """SELECT count(*) AS lines, count(depth) AS rows_with_eval, count(*) - count(depth) AS rows_missing_eval,
             count(*) FILTER (WHERE depth > before) AS updated_keys,
             count(*) FILTER (WHERE depth <= before) AS kept_existing_keys
           FROM (SELECT b.depth, coalesce(max(b.depth) OVER (PARTITION BY zobr64 ORDER BY row_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before
                 FROM keyed LEFT JOIN best_last b USING (row_id))""",
    ),
    "longest_depth_per_fen": _query(
        ["keyed", "entries"],
        """SELECT fen, max(depth) AS longest_depth FROM keyed LEFT JOIN entries USING (row_id) GROUP BY fen""",
    ),
    "row_longest_depth": _query(
        ["keyed", "entries"],
        """SELECT row_id, max(depth) AS row_longest_depth FROM keyed LEFT JOIN entries USING (row_id) GROUP BY row_id""",
    ),
    "assert_required": _query(
        ["keyed", "entries"],
        """SELECT row_id, coalesce(bool_or(knodes % 7 = 0 OR knodes % 11 = 0), false) AS missing_field
           FROM keyed LEFT JOIN entries USING (row_id) GROUP BY row_id""",
    ),
    "job_metrics": _query(
        ["keyed", "best_first", "best_last"],
        """SELECT count(*) AS input_rows, count(*) - count(f.depth) AS skipped_without_eval,
             count(f.depth) AS rows_with_eval, count(*) - count(l.depth) AS missing_eval_last
           FROM keyed LEFT JOIN best_first f USING (row_id) LEFT JOIN best_last l USING (row_id)""",
    ),
    "load_metrics": _query(
        ["enc_flat"],
        """SELECT count(*) AS input_rows, count(encode_error) AS skipped_rows,
             count(DISTINCT CASE WHEN encode_error IS NULL THEN zobr64 END) AS written_keys FROM enc_flat""",
    ),
    "pack_move_meta": _query(["flat"], f"SELECT {_LINE}, CAST({_META} AS INT) AS move_meta FROM flat"),
    "score_of": _query(
        ["flat"],
        f"""SELECT {_LINE}, CAST({_SCORE} AS INT) AS score, CAST({_KIND} AS INT) AS kind, CAST({_DEPTH} AS INT) AS depth
            FROM flat""",
    ),
    "encode_errors": _query(
        ["enc_flat"],
        f"""SELECT {_LINE}, encode_error, CASE WHEN encode_error = 'castling' THEN fen_letter END AS bad_letter FROM enc_flat""",
    ),
    "encode_entry": _query(["ent_flat"], f"SELECT {_LINE}, entry FROM ent_flat"),
    "kv_all_entries": _query(
        ["ent_flat"],
        f"""SELECT {_KHEX} AS k, printf('%02X', count(*)) || string_agg(entry, '' ORDER BY fen, {_LINE}) AS v
            FROM ent_flat GROUP BY zobr64""",
    ),
    "decode_kv": _query(
        ["enc_simplified"],
        f"""SELECT {_ZTEXT}, CAST(row_number() OVER (PARTITION BY zobr64 ORDER BY fen) - 1 AS INT) AS nth,
              CAST(score AS INT) AS score, CAST({_KIND} AS INT) AS kind, CAST({_DEPTH} AS INT) AS depth,
              CAST(CASE WHEN {_NULL_MOVE} THEN 0 ELSE {_square("first_move", 1)} END AS INT) AS from_square,
              CAST(CASE WHEN {_NULL_MOVE} THEN 0 ELSE {_square("first_move", 3)} END AS INT) AS to_square,
              CAST(CASE WHEN {_NULL_MOVE} THEN 0 ELSE {_PROMO} END AS INT) AS promotion, fen
            FROM enc_simplified WHERE encode_error IS NULL""",
    ),
    "castling_letter_distribution": _query(
        ["enc_flat"],
        f"""SELECT * FROM (WITH found_letters AS (SELECT fen_letter AS letter, count(*) AS rows FROM enc_flat
              WHERE encode_error = 'castling' GROUP BY fen_letter) {_LETTERS})""",
    ),
    "castling_distribution_by_decile": _query(
        ["moved"],
        """SELECT p.percent, coalesce(letter, '-') AS letter, coalesce(n, 0) AS rows
           FROM (SELECT CAST(unnest(range(10, 101, 10)) AS INT) AS percent) p
           LEFT JOIN (SELECT q.percent, letter, count(*) AS n
                      FROM moved, (SELECT CAST(unnest(range(10, 101, 10)) AS INT) AS percent) q
                      WHERE letter IS NOT NULL AND o_orderkey * 100 < total * q.percent GROUP BY q.percent, letter) m
             ON m.percent = p.percent""",
    ),
    "bad_castling_scan": _query(
        ["moved"],
        """SELECT o_orderkey, fen, letter AS bad_letter FROM moved
           WHERE letter IS NOT NULL AND o_orderkey < ceil(total * 0.25)""",
    ),
    "castling_possible": _query(
        ["made", "built_made"],
        """SELECT row_id, coalesce(castling <> '-' AND translate(castling, 'KQkq', '') = ''
             AND (syntax IS NULL OR syntax <> 'board')
             AND (wk OR NOT contains(castling, 'K')) AND (wq OR NOT contains(castling, 'Q'))
             AND (bk OR NOT contains(castling, 'k')) AND (bq OR NOT contains(castling, 'q')), false) AS possible
           FROM made JOIN built_made USING (fen)""",
    ),
    "position_key": _query(
        ["made", "built_made", "keys_made"],
        """SELECT row_id, CASE WHEN e IS NULL THEN CAST(hi AS VARCHAR) END AS zobr64,
             CASE WHEN e IS NULL THEN lpad(hex(hi), 16, '0') || lpad(hex(lo), 16, '0') END AS zobr128, e AS position_error
           FROM (SELECT row_id, hi, lo, CASE WHEN syntax IS NOT NULL THEN 'syntax: ' || syntax
                        WHEN bad IS NOT NULL THEN 'position: ' || bad END AS e
                 FROM made JOIN built_made USING (fen) LEFT JOIN keys_made USING (id))""",
    ),
    "position_problems": _query(
        ["made", "pos_made", "flags_made"],
        """SELECT row_id, coalesce(nullif(concat_ws('; ',
             CASE WHEN s_start THEN 'impossible side to move for standard starting board' END,
             CASE WHEN s_syntax THEN 'invalid fen syntax' END,
             CASE WHEN e_castling THEN 'invalid castling rights' END,
             CASE WHEN e_ep THEN 'invalid en-passant square' END,
             CASE WHEN e_check THEN 'impossible check state' END,
             CASE WHEN e_material THEN 'too much material' END,
             CASE WHEN x_castling AND NOT e_castling THEN 'castling not possible from this position' END,
             CASE WHEN x_ep THEN 'en-passant not possible from this position' END,
             CASE WHEN s_bad THEN 'unrecoverable position error' END), ''), 'OK') AS problems,
           """ + _REPORTED + """
           FROM made JOIN pos_made USING (fen) JOIN flags_made USING (id)""",
    ),
    "duplicate_keys": _query(
        ["keyed"],
        f"""SELECT {_ZTEXT}, n AS count, first_idx FROM (
              SELECT zobr64, count(*) AS n, min(row_id) AS first_idx FROM keyed GROUP BY zobr64)
            WHERE n > 1 ORDER BY first_idx LIMIT 100""",
    ),
    "collision_profile": _query(
        ["profile"],
        f"""SELECT {_ZTEXT}, rows, fen_unique, board_unique, turn_unique, castling_unique, ep_unique, castle_rights_only,
            {_TYPE} AS difference_type FROM profile""",
    ),
    "collision_fens": _query(
        ["keyed", "repeated"],
        f"""SELECT CAST(k.zobr64 AS VARCHAR) AS zobr64, fen, count(*) AS copies
            FROM keyed k WHERE k.zobr64 IN (SELECT zobr64 FROM repeated) GROUP BY k.zobr64, fen""",
    ),
    "collision_summary": _query(
        ["profile"], f"SELECT {_TYPE} AS difference_type, count(*) AS keys FROM profile GROUP BY 1"
    ),
    "duplicate_summary": _query(
        ["keyed"],
        """SELECT count(*) AS total_rows, count(*) FILTER (WHERE zobr64 = before) AS duplicate_rows
           FROM (SELECT zobr64, lag(zobr64) OVER (ORDER BY zobr64) AS before FROM keyed)""",
    ),
    "duplicated_keys": _query(
        ["repeated"], f"SELECT {_ZTEXT}, rows FROM (SELECT * FROM repeated ORDER BY zobr64 LIMIT 20)"
    ),
    "duplicate_fens": _query(
        ["keyed", "repeated"],
        """SELECT CAST(zobr64 AS VARCHAR) AS zobr64, rows, count(*) OVER (PARTITION BY zobr64) AS unique_fens, first_idx, fen
           FROM (SELECT zobr64, rows, fen, min(row_id) AS first_idx
                 FROM keyed JOIN (SELECT * FROM repeated ORDER BY zobr64 LIMIT 20) USING (zobr64)
                 GROUP BY zobr64, rows, fen)""",
    ),
    "rows_with_duplicate_key": _query(
        ["simplified"],
        f"""SELECT {_ZTEXT}, fen, depth FROM (SELECT *, count(*) OVER (PARTITION BY zobr64) AS n FROM simplified)
            WHERE n > 1""",
    ),
    "lookup_key": _query(
        ["keyed"], f"SELECT row_id, {_ZTEXT}, fen FROM keyed WHERE row_id BETWEEN 8 AND 15"
    ),
    "row_ordinal": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ord FROM orders",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "head_percent": """SELECT o_orderkey, o_custkey FROM orders
      WHERE o_orderkey < (SELECT ceil(count(*) * 0.01) FROM orders)""",
    "slice_rows": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 100",
    "global_sort": _query(
        ["keyed"],
        """SELECT row_number() OVER (ORDER BY CASE WHEN row_id % 3 <> 0 THEN zobr64 END NULLS FIRST, row_id) - 1 AS ord,
             row_id, CASE WHEN row_id % 3 <> 0 THEN CAST(zobr64 AS VARCHAR) END AS zobr64, fen FROM keyed""",
    ),
    "sortedness_violations": _query(
        ["keyed"],
        f"""SELECT file, row_id AS row, {_BITS.replace("zobr64", "before")} AS previous_key64, {_BITS} AS key64
            FROM (SELECT *, lag(zobr64) OVER (ORDER BY file, row_id) AS before
                  FROM (SELECT *, 'part-' || ((row_id // 1000) % 7) AS file FROM keyed)) WHERE zobr64 < before""",
    ),
    "is_sorted_head": _query(
        ["keyed"],
        """SELECT count(*) AS rows, bool_and(coalesce(zobr64 >= before, true)) AS is_sorted
           FROM (SELECT zobr64, lag(zobr64) OVER (ORDER BY row_id) AS before
                 FROM (SELECT * FROM keyed ORDER BY row_id LIMIT 20))""",
    ),
    "extract_positions": _query(["found"], "SELECT doc_id, zobr64, fen FROM found"),
    "positions_of_lines": _query(["found_file"], "SELECT doc_id, zobr64, fen FROM found_file"),
    "group_positions": _query(
        ["found"],
        """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS INT) AS group_no, zobr64,
             CAST(n AS INT) AS n_fens, fens
           FROM (SELECT doc_id, zobr64, min(i) AS first, count(*) AS n, string_agg(fen, '|' ORDER BY i) AS fens
                 FROM found GROUP BY doc_id, zobr64)""",
    ),
    "diagnose_text": _query(
        ["found", "pos_found", "flags_found"],
        """SELECT doc_id, zobr64, fen, """ + _REPORTED + """
           FROM found JOIN pos_found USING (fen) JOIN flags_found USING (id)""",
    ),
    "extraction_totals": _query(
        ["found"],
        """SELECT doc_id, count(*) AS fens, count(DISTINCT zobr64) + CAST(bool_or(zobr64 IS NULL) AS BIGINT) AS groups
           FROM found GROUP BY doc_id""",
    ),
}
# An update ends in the table of one build over all lines.
ORACLES["update_deepest_job"] = ORACLES["build_deepest_job"]
_FIFTIETH = _query(["keyed"], "SELECT format('{:016X}', CAST(zobr64 AS UBIGINT)) FROM keyed WHERE row_id % 50 = 0")
ORACLES["lookup_keys"] = f"SELECT k, v FROM ({ORACLES['build_kv_job']}) AS kv WHERE k IN ({_FIFTIETH})"
ORACLES["position_key_per_file"] = f"SELECT row_id, zobr64, true AS same_file FROM ({ORACLES['add_position_key_job']}) AS keyed"
ORACLES["latest_catalog_table"] = ORACLES["build_latest_job"]
ORACLES["duplicates_of_sorted"] = _query(
    ["keyed"], "SELECT CAST(zobr64 AS VARCHAR) AS zobr64, count(*) AS n FROM keyed GROUP BY keyed.zobr64 HAVING count(*) > 1"
)
