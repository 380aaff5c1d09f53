"""DuckDB SQL twins of the fixtures and expressions (the correctness oracle).

The driver registers the parquet tables as views and runs these strings next
to the Spark queries.  Regular expressions are shared with
``lexiflow.functions.text`` (RE2 reads the same ``\\x{..}`` classes as Java);
only the back-reference syntax of replacements differs (``$1`` vs ``\\1``).
"""

from __future__ import annotations

from lexiflow.functions.lattice import SPACE, UNKNOWN_PENALTY
from lexiflow.functions.text import BLEU_13A_REPLACE, BLEU_13A_RULES, PY_WHITESPACE, ROUGE_TOKEN, WS_RUN
from lexiflow.sources import fixtures as fx


def q(s: str) -> str:
    """SQL string literal built with chr() for characters that are not printable ASCII."""
    parts: list[str] = []
    buf = ""
    for ch in s:
        if 32 <= ord(ch) < 127:
            buf += "''" if ch == "'" else ch
        else:
            if buf:
                parts.append(f"'{buf}'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
    if buf or not parts:
        parts.append(f"'{buf}'")
    return "(" + " || ".join(parts) + ")"


WS = q(PY_WHITESPACE)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def split_ws(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS_RUN)}), lambda w: w <> '')"


def tok13a(x: str) -> str:
    s = f"rtrim({x}, {WS})"
    for old, new in BLEU_13A_REPLACE:
        s = f"replace({s}, {q(old)}, {q(new)})"
    s = f"(' ' || {s} || ' ')"
    for pat, repl in BLEU_13A_RULES:
        s = f"regexp_replace({s}, {q(pat)}, {q(repl.replace('$', chr(92)))}, 'g')"
    return split_ws(s)


def rouge_tok(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{ROUGE_TOKEN}')"


def split_of(id_expr: str) -> str:
    return (f"CASE WHEN {id_expr} % 10 = 0 THEN 'test' WHEN {id_expr} % 10 = 1 THEN 'validation' "
            f"ELSE 'train' END")


RECORDS = f"""
SELECT {split_of('d.doc_id')} AS split, d.doc_id AS row_id, d.text AS document, coalesce(n.text, '') AS summary
FROM documents d LEFT JOIN documents n ON n.doc_id = d.doc_id + 1"""

PAIRS = f"""
SELECT {split_of('u.conv_id')} AS split, u.conv_id * {fx.TURNS} + u.turn AS line_no, u.text AS src, a.text AS tgt
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""

SRC_SIDE = f"SELECT {split_of('conv_id')} AS split, conv_id * {fx.TURNS} + turn AS line_no, text AS src FROM conversations WHERE role = 'user'"
TGT_SIDE = f"SELECT {split_of('conv_id')} AS split, conv_id * {fx.TURNS} + turn - 1 AS line_no, text AS tgt FROM conversations WHERE role = 'assistant' AND turn > 0"

PIECES = f"""
SELECT piece, CAST(row_number() OVER (ORDER BY n DESC, piece ASC) + {fx.FIRST_TOKEN_ID - 1} AS INTEGER) AS id,
       floor(ln(n / (sum(n) OVER ())) * 1000) AS score
FROM (SELECT w[i:i + k - 1] AS piece, count(*) AS n
      FROM (SELECT w, i, unnest(generate_series(1, least(4, length(w) - i + 1))) AS k
            FROM (SELECT w, unnest(generate_series(1, length(w))) AS i
                  FROM (SELECT {q(SPACE)} || unnest({split_ws('text')}) AS w FROM benchmark)))
      GROUP BY ALL)"""

DOC_PAIRS = f"""
SELECT {split_of('a.doc_id')} AS split, a.doc_id AS pair_id, a.text AS pred, b.text AS ref
FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"""

VOCAB = f"""
SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token ASC) + {fx.FIRST_TOKEN_ID - 1} AS INTEGER) AS id
FROM (SELECT token, count(*) AS n FROM (SELECT unnest({split_ws('text')}) AS token FROM documents)
      GROUP BY token ORDER BY n DESC, token ASC)"""

SCORES = f"""
SELECT CAST(vec_id // {fx.SCORE_BATCH} AS BIGINT) AS batch_id, vec_id AS example,
       CAST(vec_id % {fx.SCORE_BATCH} AS INTEGER) AS pos,
       CAST((vec_id // {fx.SCORE_BATCH}) % {fx.SCORE_RANKS} AS INTEGER) AS rank,
       CAST(embedding AS DOUBLE[]) AS scores, CAST(label AS INTEGER) AS label
FROM embeddings"""

RUN_METRICS = """
SELECT user_id AS run,
       CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS INTEGER) AS epoch,
       event_type AS metric, value, props
FROM events"""


def ngrams_sql(tok_rel: str, max_n: int, keys: str) -> str:
    """(keys, h, n, gram) rows from a relation (keys, h, t)."""
    return f"""
SELECT {keys}, h, n, array_to_string(t[i:i + n - 1], ' ') AS gram
FROM (SELECT {keys}, h, n, t, unnest(generate_series(1, len(t) - n + 1)) AS i
      FROM {tok_rel}, (SELECT unnest(generate_series(1, {max_n})) AS n) ns)"""


def bleu_formula(m: list[str], t: list[str], sys_len: str, ref_len: str) -> str:
    logs = []
    k_terms = []
    for mn, tn in zip(m, t):
        k_terms.append(f"CAST({mn} = 0 AS INTEGER)")
        k = " + ".join(k_terms)
        logs.append(f"ln(CASE WHEN {mn} > 0 THEN 100.0 * {mn} / {tn} ELSE 100.0 / (pow(2.0, {k}) * {tn}) END)")
    degenerate = " OR ".join(f"{tn} = 0" for tn in t) + " OR (" + " AND ".join(f"{mn} = 0" for mn in m) + ")"
    bp = (f"CASE WHEN {sys_len} >= {ref_len} THEN 1.0 WHEN {sys_len} > 0 "
          f"THEN exp(1.0 - CAST({ref_len} AS DOUBLE) / {sys_len}) ELSE 0.0 END")
    return f"CASE WHEN {degenerate} THEN 0.0 ELSE ({bp}) * exp(({' + '.join(logs)}) / {len(m)}.0) END"


def bleu_sql(pairs_rel: str, id_col: str, pred: str, ref: str, by: str | None = None) -> str:
    keys = id_col if by is None else f"{by}, {id_col}"
    grp = "" if by is None else f"GROUP BY {by}"
    sel_by = "" if by is None else f"{by}, "
    m = [f"m{n}" for n in range(1, 5)]
    t = [f"t{n}" for n in range(1, 5)]
    stats = ", ".join(
        [f"CAST(coalesce(sum(CASE WHEN n = {n} THEN least(ch, cr) END), 0) AS BIGINT) AS m{n}" for n in range(1, 5)]
        + [f"CAST(coalesce(sum(CASE WHEN n = {n} THEN ch END), 0) AS BIGINT) AS t{n}" for n in range(1, 5)]
        + ["CAST(coalesce(sum(CASE WHEN n = 1 THEN ch END), 0) AS BIGINT) AS sys_len",
           "CAST(coalesce(sum(CASE WHEN n = 1 THEN cr END), 0) AS BIGINT) AS ref_len"]
    )
    return f"""
WITH p AS ({pairs_rel}),
tok AS (SELECT {keys}, 1 AS h, {tok13a(pred)} AS t FROM p
        UNION ALL SELECT {keys}, 0 AS h, {tok13a(ref)} AS t FROM p),
g AS ({ngrams_sql('tok', 4, keys)}),
c AS (SELECT {keys}, n, gram, sum(h) AS ch, sum(1 - h) AS cr FROM g GROUP BY ALL),
s AS (SELECT {sel_by}{stats} FROM c {grp})
SELECT {sel_by}round({bleu_formula(m, t, 'sys_len', 'ref_len')}, 6) AS bleu, {', '.join(m + t)}, sys_len, ref_len
FROM s"""


# --- encoding / decoding twins ---------------------------------------------------

def ids_str(x: str) -> str:
    return f"array_to_string({x}, ' ')"


def int_list(ids) -> str:
    return "[" + ", ".join(str(int(i)) for i in ids) + "]::INTEGER[]"


def encode_sql(rel: str, key: str, carry: list[str], cols: dict[str, str], prefix=(fx.BOS_ID,), suffix=(fx.EOS_ID,), strip_text: bool = False) -> str:
    """Relation (key, carry…, out…) with id lists, like ``prep.encode``."""
    sides = " UNION ALL ".join(
        f"SELECT {key}, {i} AS side, {split_ws(strip(c) if strip_text else c)} AS t FROM src"
        for i, c in enumerate(cols)
    )
    outs = ", ".join(
        f"list_concat({int_list(prefix)}, coalesce(l{i}.body, []::INTEGER[]), {int_list(suffix)}) AS {o}"
        for i, o in enumerate(cols.values())
    )
    joins = " ".join(f"LEFT JOIN lists l{i} ON l{i}.{key} = src.{key} AND l{i}.side = {i}" for i in range(len(cols)))
    carry_sel = "".join(f"src.{c}, " for c in carry)
    return f"""(WITH src AS ({rel}), voc AS ({VOCAB}),
toks AS (SELECT {key}, side, unnest(t) AS tok, unnest(generate_series(1, len(t))) AS pos FROM ({sides})),
ids AS (SELECT toks.{key}, side, pos, coalesce(voc.id, {fx.UNK_ID}) AS id FROM toks LEFT JOIN voc ON voc.token = toks.tok),
lists AS (SELECT {key}, side, list(id ORDER BY pos) AS body FROM ids GROUP BY {key}, side)
SELECT src.{key}, {carry_sel}{outs} FROM src {joins})"""


def piece_lists(rel: str, key: str, col: str) -> str:
    """Relation (key, ids): best paths of the words of ``col`` over PIECES, word by word.

    The recursion walks a word's end positions; ``best`` lists (sum, ids, unknown last) of all ends so far,
    and edges are tried from the longest piece on, so that a later one must be better to win."""
    return f"""(WITH RECURSIVE src AS ({rel}), pc AS ({PIECES}),
toks AS (SELECT {key}, unnest(t) AS tok, unnest(generate_series(1, len(t))) AS pos FROM (SELECT {key}, {split_ws(col)} AS t FROM src)),
w AS (SELECT DISTINCT tok, {q(SPACE)} || tok AS w FROM toks),
ends AS (SELECT tok, w, unnest(generate_series(1, length(w))) AS e FROM w),
spans AS (SELECT tok, e, unnest(generate_series(greatest(0, e - 4), e - 1)) AS s, w FROM ends),
edges AS (SELECT tok, e, s, coalesce(pc.id, {fx.UNK_ID}) AS id, coalesce(pc.score, (SELECT min(score) FROM pc) - {UNKNOWN_PENALTY}) AS score
  FROM spans LEFT JOIN pc ON pc.piece = w[s + 1:e] WHERE pc.id IS NOT NULL OR s = e - 1),
lat AS (SELECT tok, e, list(struct_pack(s := s, id := id, score := score) ORDER BY s) AS el FROM edges GROUP BY tok, e),
walk(tok, e, best) AS (
  SELECT tok, 0::BIGINT, [struct_pack(total := 0.0::DOUBLE, ids := []::INTEGER[])] FROM w
  UNION ALL
  SELECT walk.tok, walk.e + 1, list_append(best, list_reduce(
      list_transform(el, lambda x: struct_pack(total := best[x.s + 1].total + x.score,
        ids := CASE WHEN x.id = {fx.UNK_ID} AND list_last(best[x.s + 1].ids) = {fx.UNK_ID} THEN best[x.s + 1].ids
                    ELSE list_append(best[x.s + 1].ids, x.id) END)),
      lambda a, b: CASE WHEN b.total > a.total THEN b ELSE a END))
  FROM walk JOIN lat ON lat.tok = walk.tok AND lat.e = walk.e + 1),
done AS (SELECT tok, arg_max(best, e)[-1].ids AS ids FROM walk GROUP BY tok),
g AS (SELECT toks.{key}, flatten(list(done.ids ORDER BY pos)) AS ids FROM toks JOIN done ON done.tok = toks.tok GROUP BY toks.{key})
SELECT src.{key}, coalesce(g.ids, []::INTEGER[]) AS ids FROM src LEFT JOIN g ON g.{key} = src.{key})"""


def truncate_sql(x: str, max_len: int, n_prefix: int = 1, n_suffix: int = 1) -> str:
    keep = max(max_len - n_prefix - n_suffix, 0)
    head = f"{x}[1:{n_prefix}]" if n_prefix else "[]::INTEGER[]"
    tail = f"{x}[len({x}) - {n_suffix - 1}:len({x})]" if n_suffix else "[]::INTEGER[]"
    body = f"{x}[{n_prefix + 1}:least(len({x}) - {n_suffix}, {n_prefix + keep})]"
    return f"list_concat({head}, {body}, {tail})"


def decode_sql(rel: str, key: str, col: str, out: str = "text", carry: tuple = ()) -> str:
    """Relation (key, carry…, out) with ids decoded to text (specials skipped)."""
    specials = int_list(fx.SPECIAL_IDS)
    carry_sel = "".join(f"src.{c}, " for c in carry)
    return f"""(WITH src AS ({rel}), voc AS ({VOCAB}),
e AS (SELECT {key}, unnest(f) AS id, unnest(generate_series(1, len(f))) AS pos
      FROM (SELECT {key}, list_filter({col}, lambda i: NOT list_contains({specials}, i)) AS f FROM src)),
w AS (SELECT e.{key}, list(voc.token ORDER BY e.pos) FILTER (WHERE voc.token IS NOT NULL) AS toks
      FROM e LEFT JOIN voc ON voc.id = e.id GROUP BY e.{key})
SELECT src.{key}, {carry_sel}coalesce(array_to_string(w.toks, ' '), '') AS {out}
FROM src LEFT JOIN w ON w.{key} = src.{key})"""


def lcs_sql(rel: str, key: str, a: str, b: str) -> str:
    """Relation (key, na, nb, lcs): LCS length of two token lists by a recursive
    CTE over the rows of the DP table (prefix-max form of the recurrence)."""
    return f"""(WITH RECURSIVE p AS (SELECT {key}, {a} AS a, {b} AS b FROM ({rel})),
cells AS (SELECT {key}, unnest(generate_series(0, len(b))) AS j FROM p),
dp({key}, i, j, v) AS (
  SELECT {key}, 0::BIGINT, j, 0::BIGINT FROM cells
  UNION ALL
  SELECT {key}, i, j, max(c) OVER (PARTITION BY {key} ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (SELECT d.{key}, d.i + 1 AS i, d.j,
               CASE WHEN d.j = 0 THEN 0 ELSE greatest(d.v, coalesce(lag(d.v) OVER (PARTITION BY d.{key} ORDER BY d.j), 0)
                    + CASE WHEN p.a[d.i + 1] = p.b[d.j] THEN 1 ELSE 0 END) END AS c
        FROM dp d JOIN p ON p.{key} = d.{key}
        WHERE d.i < len(p.a)) s
)
SELECT p.{key}, len(p.a) AS na, len(p.b) AS nb, d.v AS lcs
FROM p JOIN dp d ON d.{key} = p.{key} AND d.i = len(p.a) AND d.j = len(p.b))"""


def lsum_sql(rel: str, key: str, pred: str, ref: str) -> str:
    """Relation (key, rougeLsum): summary-level ROUGE-L.  For every reference and prediction sentence a recursion
    over the reference words keeps, for each prefix of the prediction, the hits that a walk back from there
    would find (so their number is the LCS length); the united hits of a reference sentence are clipped per
    token by the prediction's counts."""
    def sents(x: str) -> str:
        return f"list_transform(list_filter(string_split({x}, chr(10)), lambda s: s <> ''), lambda s: {rouge_tok('s')})"
    return f"""(WITH RECURSIVE p AS (SELECT {key}, {sents(ref)} AS rs, {sents(pred)} AS cs FROM ({rel})),
r AS (SELECT {key}, unnest(rs) AS r, unnest(generate_series(1, len(rs))) AS ri FROM p),
c AS (SELECT {key}, unnest(cs) AS c, unnest(generate_series(1, len(cs))) AS ci FROM p),
sp AS (SELECT row_number() OVER () AS id, r.{key}, ri, r, c FROM r JOIN c ON c.{key} = r.{key} WHERE list_has_any(r, c)),
dp(id, i, r, c, held) AS (
  SELECT id, 0::BIGINT, r, c, list_transform(generate_series(0, len(c)), lambda x: []::BIGINT[]) FROM sp
  UNION ALL
  SELECT id, i + 1, r, c, list_reduce(list_concat([[[]::BIGINT[]]], list_transform(generate_series(1, len(c)), lambda j: [[j]])),
    lambda done, x: list_append(done, CASE WHEN r[i + 1] = c[x[1][1]] THEN list_append(held[x[1][1]], i + 1)
      WHEN len(done[-1]) > len(held[x[1][1] + 1]) THEN done[-1] ELSE held[x[1][1] + 1] END))
  FROM dp WHERE i < len(r)),
ends AS (SELECT id, held[-1] AS hits FROM dp WHERE i = len(r)),
un AS (SELECT {key}, ri, any_value(r) AS r, list_distinct(flatten(list(hits))) AS hits FROM ends JOIN sp ON sp.id = ends.id GROUP BY {key}, ri),
ut AS (SELECT {key}, tok, count(*) AS n FROM (SELECT {key}, unnest(list_transform(hits, lambda k: r[k])) AS tok FROM un) GROUP BY {key}, tok),
ct AS (SELECT {key}, tok, count(*) AS n FROM (SELECT {key}, unnest(c) AS tok FROM c) GROUP BY {key}, tok),
h AS (SELECT ut.{key}, sum(least(ut.n, ct.n)) AS hits FROM ut JOIN ct ON ct.{key} = ut.{key} AND ct.tok = ut.tok GROUP BY ut.{key})
SELECT p.{key}, {f_measure('coalesce(h.hits, 0)', 'len(flatten(rs))', 'len(flatten(cs))')} AS rougeLsum FROM p LEFT JOIN h ON h.{key} = p.{key})"""


def f_measure(m: str, p: str, r: str) -> str:
    return f"CASE WHEN {m} > 0 THEN 2.0 * {m} / ({p} + {r}) ELSE 0.0 END"


def rouge_n_sql(rel: str, key: str, pred: str, ref: str, orders=(1, 2)) -> str:
    """Relation (key, rouge{n}…) per pair."""
    max_n = max(orders)
    cols = ", ".join(
        f"{f_measure(f'coalesce(sum(CASE WHEN n = {n} THEN least(ch, cr) END), 0)', f'coalesce(sum(CASE WHEN n = {n} THEN ch END), 0)', f'coalesce(sum(CASE WHEN n = {n} THEN cr END), 0)')} AS rouge{n}"
        for n in orders
    )
    return f"""(WITH src AS ({rel}),
tok AS (SELECT {key}, 1 AS h, {rouge_tok(pred)} AS t FROM src UNION ALL SELECT {key}, 0 AS h, {rouge_tok(ref)} AS t FROM src),
g AS ({ngrams_sql('tok', max_n, key)}),
c AS (SELECT {key}, n, gram, sum(h) AS ch, sum(1 - h) AS cr FROM g GROUP BY ALL)
SELECT src.{key}, {cols}
FROM src LEFT JOIN c ON c.{key} = src.{key} GROUP BY src.{key})"""
