"""DuckDB SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

from isoframe.plans.fixtures import VIEWS

_NEEDS = {"fx_sj": ["fx_exon"]}


def _ctes(*names: str, more: str = "") -> str:
    order = [n for n in VIEWS if n in names or any(n in _NEEDS.get(m, []) for m in names)]
    parts = [f"{n} AS ({VIEWS[n]})" for n in order]
    return "WITH " + ",\n".join(parts + ([more.strip()] if more else [])) + "\n"


_TR = """
ex AS (
  SELECT ok, gene, tid, kind, is_rev, es, ee, row_number() OVER (PARTITION BY ok ORDER BY es, ee) - 1 AS j, count(*) OVER (PARTITION BY ok) AS n
  FROM fx_exon
), tr AS (
  SELECT ok, min(gene) AS gene, min(tid) AS tid, min(kind) AS kind, max(is_rev) = 1 AS is_rev, min(es) AS s, max(ee) AS e, count(*) AS n
  FROM fx_exon GROUP BY ok
), reads AS (SELECT * FROM tr WHERE kind = 'read'), anno AS (SELECT * FROM tr WHERE kind = 'anno')
"""

_PAIRS = _TR + """
, pairs AS (
  SELECT r.ok AS r, a.ok AS a, greatest(r.s, a.s) AS lo, least(r.e, a.e) AS hi, r.n AS n, a.n AS m, a.gene AS gene, a.is_rev AS anno_rev
  FROM reads r JOIN anno a ON r.tid = a.tid AND r.e > a.s AND a.e > r.s
)
"""

_FRACTION = """CASE WHEN x.es > y.ee OR y.es > x.ee THEN CAST(0 AS FLOAT)
       ELSE CAST((least(x.ee, y.ee) - greatest(x.es, y.es) + 1) / (least(x.ee - x.es, y.ee - y.es) + 1) AS FLOAT) END"""


def _classified(compat: bool = True) -> str:
    """CTEs up to ``cls``, one row for each read, and ``seen``, visited pairs."""
    own = "x.j < p.n - 1" if compat else "x.j > 0"
    return _PAIRS + f""", sites AS (
  SELECT p.r, p.a, count(*) AS there FROM pairs p JOIN ex x ON x.ok = p.r
  JOIN (VALUES (0), (1)) k(k) ON (k = 0 AND x.j < p.n - 1 AND x.ee BETWEEN p.lo AND p.hi) OR (k = 1 AND x.j > 0 AND x.es BETWEEN p.lo AND p.hi)
  WHERE p.n > 1 AND p.m > 1 GROUP BY p.r, p.a
), don AS (
  SELECT p.r, p.a, x.j FROM pairs p JOIN ex x ON x.ok = p.r AND x.j < p.n - 1 JOIN ex y ON y.ok = p.a AND y.j < p.m - 1 AND y.ee = x.ee
  WHERE p.n > 1 AND p.m > 1 AND y.ee BETWEEN p.lo AND p.hi
), acc AS (
  SELECT p.r, p.a, x.j - {0 if compat else 1} AS j FROM pairs p JOIN ex x ON x.ok = p.r AND {own} JOIN ex y ON y.ok = p.a AND y.j > 0 AND y.es = x.es
  WHERE p.n > 1 AND p.m > 1 AND y.es BETWEEN p.lo AND p.hi
), same AS (SELECT r, a, count(*) AS same FROM (SELECT r, a FROM don UNION ALL SELECT r, a FROM acc) GROUP BY r, a
), said AS (
  SELECT p.*, CASE WHEN p.n > 1 AND p.m > 1 THEN coalesce(t.there, 0) = 2 * (p.n - 1) AND coalesce(s.same, 0) = coalesce(t.there, 0)
              WHEN p.n = 1 AND p.m = 1 THEN {_FRACTION} >= CAST(0.8 AS FLOAT) ELSE false END AS is_known,
         coalesce(s.same, 0) AS same
  FROM pairs p LEFT JOIN sites t ON t.r = p.r AND t.a = p.a LEFT JOIN same s ON s.r = p.r AND s.a = p.a
  JOIN ex x ON x.ok = p.r AND x.j = 0 JOIN ex y ON y.ok = p.a AND y.j = 0
), firsts AS (SELECT r, min(a) AS a FROM said WHERE is_known GROUP BY r
), seen AS (
  SELECT s.*, s.n > 1 AND s.m > 1 AND NOT is_known AND same > 0 AS shares FROM said s LEFT JOIN firsts f ON f.r = s.r WHERE f.a IS NULL OR s.a <= f.a
), cls AS (
  SELECT t.ok, t.tid, t.s, t.e, t.n, coalesce(bool_or(is_known), false) AS known, coalesce(bool_or(shares), false) AS shares,
         arg_max(v.gene, v.a) FILTER (WHERE is_known OR shares) AS gene, coalesce(arg_max(anno_rev, v.a) FILTER (WHERE is_known OR shares), any_value(t.is_rev)) AS is_rev
  FROM reads t LEFT JOIN seen v ON v.r = t.ok GROUP BY t.ok, t.tid, t.s, t.e, t.n
), named AS (SELECT *, CASE WHEN known THEN 'known' WHEN shares THEN 'novel' ELSE 'unrecognized' END AS class FROM cls
), nexon AS (
  SELECT x.ok, x.j, NOT bool_or(h.a IS NOT NULL) AS novel FROM ex x
  LEFT JOIN (SELECT v.r, v.a, y.es, y.ee FROM seen v JOIN ex y ON y.ok = v.a WHERE v.n > 1 AND v.m > 1) h ON h.r = x.ok AND h.es = x.es AND h.ee = x.ee
  WHERE x.kind = 'read' GROUP BY x.ok, x.j
), joint AS (
  SELECT x.ok, x.j, x.ee AS d, y.es AS c FROM ex x JOIN ex y ON y.ok = x.ok AND y.j = x.j + 1
), njoint AS (
  SELECT x.ok, x.j, x.d, x.c, NOT bool_or(h.a IS NOT NULL) AS novel FROM joint x JOIN reads t ON t.ok = x.ok
  LEFT JOIN (SELECT v.r, v.a, y.d, y.c FROM seen v JOIN joint y ON y.ok = v.a WHERE v.n > 1 AND v.m > 1) h ON h.r = x.ok AND h.d = x.d AND h.c = x.c
  GROUP BY x.ok, x.j, x.d, x.c
), nsite AS (
  SELECT x.ok, x.j, x.d, x.c, NOT EXISTS (SELECT 1 FROM don JOIN seen v ON v.r = don.r AND v.a = don.a WHERE don.r = x.ok AND don.j = x.j) AS novel_don,
         NOT EXISTS (SELECT 1 FROM acc JOIN seen v ON v.r = acc.r AND v.a = acc.a WHERE acc.r = x.ok AND acc.j = x.j) AS novel_acc
  FROM joint x JOIN reads t ON t.ok = x.ok
)"""


_JUDGED = _classified() + """, tested AS (SELECT * FROM named WHERE class = 'novel'
), near AS (SELECT DISTINCT t.ok FROM tested t JOIN fx_sj q ON q.tid = t.tid AND q.don < t.e AND q.acc > t.s
), ujoint AS (
  SELECT j.ok, j.j, j.novel AND n.ok IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM fx_sj q WHERE q.tid = t.tid AND q.don = j.d + 1 AND q.acc = j.c - 1 AND q.uniq_c >= 1) AS bad
  FROM njoint j JOIN tested t ON t.ok = j.ok LEFT JOIN near n ON n.ok = j.ok
), judged AS (
  SELECT c.*, t.ok IS NOT NULL AS tested,
         t.ok IS NOT NULL AND (n.ok IS NULL OR EXISTS (SELECT 1 FROM ujoint u WHERE u.ok = c.ok AND u.bad)) AS unreliable
  FROM named c LEFT JOIN tested t ON t.ok = c.ok LEFT JOIN near n ON n.ok = c.ok
)"""

_FLAGS = "coalesce(string_agg(CAST(CAST({0} AS INT) AS VARCHAR), '' ORDER BY j), '')"

_WALK = """
rows_ AS (SELECT qname, rec, flag, tid, pos, nh, cigar, regexp_extract_all(cigar, '([0-9]+)([MIDNSHPX=B])', 1) AS ls, regexp_extract_all(cigar, '([0-9]+)([MIDNSHPX=B])', 2) AS os FROM fx_aln
), ops AS (SELECT qname, rec, flag, tid, pos, nh, CAST(unnest(ls) AS INT) AS len, unnest(os) AS op, generate_subscripts(ls, 1) AS i FROM rows_
), walk AS (
  SELECT *, pos + coalesce(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) OVER (PARTITION BY qname, rec ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS here,
         (op = 'N' AND len >= 3) OR (op = 'D' AND len > 50) AS closes
  FROM ops
)"""

_SCORED = """
scored AS (
  SELECT qname, rec, tid, pos, l_qseq, nm, l_qseq - coalesce(TRY_CAST(regexp_extract(cigar, '^([0-9]+)[SH]', 1) AS INT), 0) - coalesce(TRY_CAST(regexp_extract(cigar, '([0-9]+)[SH]$', 1) AS INT), 0) AS covered,
         len(regexp_extract_all(cigar, 'N')) AS n_introns, coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)D', 1), lambda x: CAST(x AS INT))), 0) AS deleted,
         list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), lambda x: CAST(x AS INT))) AS ref_len
  FROM fx_aln WHERE (flag & 4) = 0
), judged AS (SELECT *, CAST(covered - nm + deleted AS INT) AS score FROM scored
), removal AS (
  SELECT min(tid) AS tid, min(es) AS s, max(ee) AS e FROM fx_exon WHERE kind = 'anno' GROUP BY ok HAVING min(gene) % 7 = 0
), outside AS (
  SELECT * FROM judged q WHERE NOT EXISTS (SELECT 1 FROM removal t WHERE t.tid = q.tid AND q.pos <= t.e AND t.s <= q.pos + q.ref_len - 1)
)"""
_COVERS = "CAST(covered AS DOUBLE) / l_qseq >= CAST(CAST(0.8 AS FLOAT) AS DOUBLE)"
_ALIKE = "CAST(score AS FLOAT) >= CAST(0.9 AS FLOAT) * CAST(covered AS FLOAT)"


def _best(source: str, introns: int) -> str:
    return f""", ranked AS (
  SELECT *, row_number() OVER w AS place, coalesce(lead(score) OVER w, 0) AS second FROM {source} WHERE {_COVERS} AND {_ALIKE}
  WINDOW w AS (PARTITION BY qname ORDER BY score DESC, rec)
), best AS (
  SELECT * FROM ranked WHERE place = 1 AND CAST(greatest(second, 0) AS FLOAT) < CAST(0.98 AS FLOAT) * CAST(score AS FLOAT) AND n_introns >= {introns}
)"""


_ORDER = """blocks AS (SELECT tid, s, e, ok, max(e) OVER (PARTITION BY tid ORDER BY s, ok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {0}
), heads AS (SELECT *, max(CASE WHEN far IS NULL OR s > far THEN s END) OVER (PARTITION BY tid ORDER BY s, ok ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM blocks)"""

_RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qname ORDER BY score DESC, ed, rec) AS k, count(*) OVER (PARTITION BY qname) AS n FROM fx_seg
), two AS (
  SELECT a.qname, a.rec AS first_ord, a.read_start AS s1, a.read_end AS e1, b.read_start AS s2, b.read_end AS e2,
         a.tid AS t1, b.tid AS t2, a.ref_start AS f1, a.ref_end AS l1, b.ref_start AS f2, b.ref_end AS l2
  FROM ranked a JOIN ranked b ON b.qname = a.qname AND a.k = 1 AND b.k = 2 WHERE a.n = 2
), rated AS (
  SELECT *, CASE WHEN s1 > e2 OR s2 > e1 THEN 0 ELSE (e1 - s2 + 1) / (least(e1 - s1, e2 - s2) + 1) END AS ratio,
         CASE WHEN s1 > e2 OR s2 > e1 THEN 0 ELSE (least(e1, e2) - greatest(s1, s2) + 1) / (least(e1 - s1, e2 - s2) + 1) END AS plain
  FROM two
), fitted AS (
  SELECT *, CAST(ratio AS FLOAT) <= CAST(0.1 AS FLOAT) AS apart, CAST(plain AS FLOAT) <= CAST(0.1 AS FLOAT) AS apart_fixed,
         t1 = t2 AND (NOT (f1 > l2 OR f2 > l1) OR (greatest(f1 - l2, f2 - l1) > 0 AND greatest(f1 - l2, f2 - l1) < 100000)) AS close_by
  FROM rated
)"""

#: Parts taken greedily, one rank after another; ``x`` is the candidate.
_GREEDY = """parts AS (
  SELECT qname, row_number() OVER (PARTITION BY qname ORDER BY score DESC, ed, rec) AS k,
         {'s': read_start, 'e': read_end, 't': tid, 'v': is_rev = 1, 'f': ref_start, 'l': ref_end} AS x
  FROM fx_seg
), walk AS (
  SELECT qname, k, [x] AS taken, false AS done FROM parts WHERE k = 1
  UNION ALL
  SELECT qname, k, taken, done OR (fits AND CAST(len(list_distinct(flatten(list_transform(taken, lambda a: range(a.s, a.e + 1))))) / 1000 AS FLOAT) >= CAST(0.99 AS FLOAT))
  FROM (SELECT qname, k, fits, done, CASE WHEN fits THEN list_append(before, x) ELSE before END AS taken
        FROM (SELECT p.qname, p.k, p.x, w.taken AS before, w.done,
                     NOT w.done AND (p.x.e - p.x.s + 1) / 1000 >= CAST(0.1 AS FLOAT) AND len(list_filter(w.taken, lambda a:
                       (NOT (a.s > p.x.e OR p.x.s > a.e) AND CAST((a.e - p.x.s + 1) / (least(a.e - a.s, p.x.e - p.x.s) + 1) AS FLOAT) > CAST(0.1 AS FLOAT))
                       OR (a.t = p.x.t AND greatest(a.f - p.x.l, p.x.f - a.l) < 100000))) = 0 AS fits
              FROM walk w JOIN parts p ON p.qname = w.qname AND p.k = w.k + 1) a) b
), ended AS (
  SELECT qname, CASE WHEN taken[1].s >= taken[2].s THEN taken[2] ELSE taken[1] END AS a, CASE WHEN taken[1].s >= taken[2].s THEN taken[1] ELSE taken[2] END AS b
  FROM walk w WHERE done AND len(taken) = 2 AND k = (SELECT max(k) FROM parts p WHERE p.qname = w.qname)
)"""

_ENDED = _classified() + """, touched AS (
  SELECT v.r, v.a, x1.ee = y1.ee AS l1, x2.es = y2.es AS r1, NOT (x1.es > y1.ee OR y1.es > x1.ee) AS l2, NOT (x2.es > y2.ee OR y2.es > x2.ee) AS r2,
         EXISTS (SELECT 1 FROM ex y WHERE y.ok = v.a AND NOT (x1.es > y.ee OR y.es > x1.ee)) AS la, EXISTS (SELECT 1 FROM ex y WHERE y.ok = v.a AND NOT (x2.es > y.ee OR y.es > x2.ee)) AS ra
  FROM seen v JOIN ex x1 ON x1.ok = v.r AND x1.j = 0 JOIN ex x2 ON x2.ok = v.r AND x2.j = v.n - 1 JOIN ex y1 ON y1.ok = v.a AND y1.j = 0 JOIN ex y2 ON y2.ok = v.a AND y2.j = v.m - 1
), ended AS (
  SELECT t.ok, coalesce(bool_or(l1), false) AS l1, coalesce(bool_or(r1), false) AS r1, coalesce(bool_or(l2), false) AS l2, coalesce(bool_or(r2), false) AS r2,
         coalesce(bool_or(la), false) AS la, coalesce(bool_or(ra), false) AS ra
  FROM reads t LEFT JOIN touched h ON h.r = t.ok GROUP BY t.ok
)"""


def _within(long: str, short: str) -> str:
    """Whether a chain goes on as another, longer one does from where it begins."""
    at = f"coalesce(list_position({long}, {short}[1]), 0)"
    m = f"least(len({short}), len({long}) - {at} + 1)"
    return f"({at} > 0 AND {long}[{at}:{at} + {m} - 1] = {short}[1:{m}])"


def _folded(source: str, p: str = "") -> str:
    """CTEs of the greedy merge of ``source``, one row after another.

    ``source`` has grp, ok, piece, rs and re (span of the read), s, e, n (exons) and j (chain).
    ``{p}held`` says which row was absorbed; ``{p}survivors`` has the survivors.
    """
    y = "before[i]"
    match = f"""CASE WHEN {y}.n = 1 AND x.n = 1 THEN CAST((least({y}.e, x.e) - greatest({y}.s, x.s) + 1) / (least({y}.e - {y}.s, x.e - x.s) + 1) AS FLOAT) >= CAST(0.8 AS FLOAT)
            WHEN {y}.n = 1 OR x.n = 1 THEN false WHEN {y}.n = x.n THEN {y}.j = x.j WHEN {y}.n > x.n THEN {_within(f'{y}.j', 'x.j')} ELSE {_within('x.j', f'{y}.j')} END"""
    return f"""{p}far AS (SELECT *, max(re) OVER (PARTITION BY grp ORDER BY rs, ok, piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {source}
), {p}isle AS (SELECT *, max(CASE WHEN far IS NULL OR rs > far THEN rs END) OVER (PARTITION BY grp ORDER BY rs, ok, piece ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isle FROM {p}far
), {p}items AS (
  SELECT grp, isle, ok, piece, row_number() OVER (PARTITION BY grp, isle ORDER BY rs, ok, piece) AS k, {{'s': s, 'e': e, 'n': n, 'j': j, 'cov': 1, 'ok': ok, 'piece': piece}} AS x FROM {p}isle
), {p}walk AS (
  SELECT grp, isle, k, CAST(0 AS BIGINT) AS hit, [x] AS kept FROM {p}items WHERE k = 1
  UNION ALL
  SELECT grp, isle, k, hit, CASE WHEN hit = 0 THEN list_append(before, x) WHEN before[hit].n <> x.n THEN before
         ELSE list_transform(before, lambda y, i: CASE WHEN i = hit THEN {{'s': least(y.s, x.s), 'e': greatest(y.e, x.e), 'n': y.n, 'j': y.j, 'cov': y.cov + 1, 'ok': y.ok, 'piece': y.piece}} ELSE y END) END
  FROM (SELECT *, coalesce(list_max(list_transform(range(halt + 1, len(before) + 1), lambda i: CASE WHEN {match} THEN i ELSE 0 END)), 0) AS hit
        FROM (SELECT w.grp, w.isle, q.k, q.x, w.kept AS before, coalesce(list_max(list_transform(w.kept, lambda y, i: CASE WHEN y.e < q.x.s THEN i ELSE 0 END)), 0) AS halt
              FROM {p}walk w JOIN {p}items q ON q.grp = w.grp AND q.isle = w.isle AND q.k = w.k + 1))
), {p}held AS (SELECT q.grp, q.isle, q.ok, q.piece, q.x, w.hit > 0 AS absorbed FROM {p}items q JOIN {p}walk w ON w.grp = q.grp AND w.isle = q.isle AND w.k = q.k
), {p}survivors AS (
  SELECT grp, y.ok AS ok, y.piece AS piece, y.s AS s, y.e AS e, y.cov AS cov
  FROM (SELECT grp, unnest(arg_max(kept, k)) AS y FROM {p}walk GROUP BY grp, isle)
)"""


#: Pieces of split reads; ``j0`` to ``j1`` are their exons.
_PIECES = """, numbered AS (
  SELECT x.ok, x.j, x.es, x.ee, j.novel, coalesce(sum(CAST(u.bad AS INT)) OVER (PARTITION BY x.ok ORDER BY x.j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cut
  FROM judged c JOIN ex x ON x.ok = c.ok LEFT JOIN njoint j ON j.ok = x.ok AND j.j = x.j LEFT JOIN ujoint u ON u.ok = x.ok AND u.j = x.j
  WHERE c.class = 'novel' AND c.unreliable
), grouped AS (
  SELECT ok, cut, min(j) AS j0, max(j) AS j1, min(es) AS s, max(ee) AS e, string_agg(CAST(es AS VARCHAR), ',' ORDER BY j) AS starts, string_agg(CAST(ee AS VARCHAR), ',' ORDER BY j) AS ends
  FROM numbered GROUP BY ok, cut HAVING count(*) > 1 AND bool_or(novel) AND bool_or(NOT novel)
), placed AS (SELECT *, row_number() OVER (PARTITION BY ok ORDER BY cut) - 1 AS piece FROM grouped)"""

#: Reads with the chains of their junctions.
_CHAINED = """, links AS (SELECT x.ok, x.j, x.ee * 100000000::BIGINT + y.es AS link FROM ex x JOIN ex y ON y.ok = x.ok AND y.j = x.j + 1
), chained AS (SELECT t.ok, t.tid, t.s, t.e, t.n, coalesce(c.j, []) AS j FROM tr t LEFT JOIN (SELECT ok, list(link ORDER BY j) AS j FROM links GROUP BY ok) c ON c.ok = t.ok)"""
_MERGED = _TR + _CHAINED + """, source AS (
  SELECT c.tid AS grp, c.ok, 0 AS piece, c.s AS rs, c.e AS re, c.s, c.e, c.n, c.j FROM chained c JOIN reads r ON r.ok = c.ok
), """ + _folded("source")

_SUMMED = _JUDGED + _PIECES + _CHAINED + """, parts AS (
  SELECT ok, 0 AS piece, 0 AS j0, n - 1 AS j1, s, e, false AS partial FROM judged WHERE class = 'novel' AND NOT unreliable
  UNION ALL SELECT ok, piece, j0, j1, s, e, true FROM placed
), source AS (
  SELECT c.tid AS grp, p.ok, p.piece, c.s AS rs, c.e AS re, p.s, p.e, p.j1 - p.j0 + 1 AS n, c.j[p.j0 + 1:p.j1] AS j FROM parts p JOIN chained c ON c.ok = p.ok
), """ + _folded("source") + """, again AS (
  SELECT c.tid * 4 + CASE WHEN q.class = 'known' THEN 0 WHEN q.class = 'unrecognized' THEN 3 WHEN q.unreliable THEN 2 ELSE 1 END AS grp, c.ok, 0 AS piece, c.s AS rs, c.e AS re, c.s, c.e, c.n, c.j
  FROM judged q JOIN chained c ON c.ok = q.ok
), """ + _folded("again", "u_") + """, new AS (
  SELECT v.ok, v.piece, v.s, v.e, p.j0, p.j1, p.partial, q.tid, q.gene FROM survivors v JOIN parts p ON p.ok = v.ok AND p.piece = v.piece JOIN judged q ON q.ok = v.ok
), new_exons AS (
  SELECT DISTINCT n.tid, CASE WHEN x.j = n.j0 THEN n.s ELSE x.es END AS s, CASE WHEN x.j = n.j1 THEN n.e ELSE x.ee END AS e
  FROM new n JOIN ex x ON x.ok = n.ok AND x.j BETWEEN n.j0 AND n.j1 JOIN nexon f ON f.ok = x.ok AND f.j = x.j WHERE f.novel
), new_sites AS (
  SELECT DISTINCT 0 AS kind, n.tid, f.d AS site FROM new n JOIN nsite f ON f.ok = n.ok AND f.j >= n.j0 AND f.j < n.j1 WHERE f.novel_don
  UNION ALL SELECT DISTINCT 1, n.tid, f.c FROM new n JOIN nsite f ON f.ok = n.ok AND f.j >= n.j0 AND f.j < n.j1 WHERE f.novel_acc
), new_joints AS (
  SELECT DISTINCT n.tid, f.d, f.c FROM new n JOIN njoint f ON f.ok = n.ok AND f.j >= n.j0 AND f.j < n.j1 WHERE f.novel
), lagged AS (SELECT gene, lag(gene) OVER (ORDER BY ok) AS before FROM anno
), names AS (SELECT * FROM (VALUES (0, 'known'), (1, 'novel_reliable'), (2, 'novel_unreliable'), (3, 'unrecognized')) v(c, class))"""
_SUMS = [
    ("annotation", "transcripts", "count(*)", "anno"), ("annotation", "genes", "count(*) FILTER (WHERE before IS NULL OR before <> gene)", "lagged"),
    ("updated", "genes", "count(DISTINCT gene)", "new"), ("updated", "transcripts", "count(*)", "new"),
    ("updated", "full", "count(*) FILTER (WHERE NOT partial)", "new"), ("updated", "partial", "count(*) FILTER (WHERE partial)", "new"),
    ("updated", "novel_exons", "count(*)", "new_exons"), ("updated", "novel_sites", "count(*)", "new_sites"), ("updated", "novel_junctions", "count(*)", "new_joints"),
    ("known", "transcripts", "count(*) FILTER (WHERE class = 'known')", "judged"), ("known", "genes", "count(DISTINCT gene) FILTER (WHERE class = 'known')", "judged"),
    ("novel", "transcripts", "count(*) FILTER (WHERE class = 'novel')", "judged"), ("novel", "reliable", "count(*) FILTER (WHERE class = 'novel' AND NOT unreliable)", "judged"),
    ("novel", "unreliable", "count(*) FILTER (WHERE class = 'novel' AND unreliable)", "judged"), ("unrecognized", "transcripts", "count(*) FILTER (WHERE class = 'unrecognized')", "judged"),
]
_UNIQUE = """SELECT regexp_extract(n.class, '^[a-z]+') AS section, 'unique_' || n.class AS metric, CAST(count(*) AS BIGINT) AS value
FROM u_survivors v JOIN names n ON n.c = v.grp % 4 GROUP BY n.class"""

ORACLES: dict[str, str] = {
    "cigar_exons": _ctes("fx_aln", more=_WALK + """, cuts AS (
  SELECT qname, rec, here AS e, here + len + 1 AS nxt, row_number() OVER (PARTITION BY qname, rec ORDER BY i) AS k FROM walk WHERE closes AND (flag & 4) = 0
), totals AS (
  SELECT qname, rec, min(pos) AS pos, min(pos) + sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) AS e FROM walk WHERE (flag & 4) = 0 GROUP BY qname, rec
), spans AS (
  SELECT c.qname, c.rec, c.k, coalesce(lag(nxt) OVER (PARTITION BY c.qname, c.rec ORDER BY k), t.pos + 1) AS s, c.e, false AS last FROM cuts c JOIN totals t ON t.qname = c.qname AND t.rec = c.rec
  UNION ALL SELECT t.qname, t.rec, 1000000, coalesce((SELECT max(nxt) FROM cuts c WHERE c.qname = t.qname AND c.rec = t.rec), t.pos + 1), t.e, true FROM totals t
)""") + "SELECT qname, rec AS ord, CAST(row_number() OVER (PARTITION BY qname, rec ORDER BY k) - 1 AS INT) AS place, CAST(s AS INT) AS exon_start, CAST(e AS INT) AS exon_end FROM spans WHERE k = 1 OR last OR e - s + 1 >= 3",
    "cigar_query_len": _ctes("fx_aln", more=_WALK) + """SELECT qname, rec AS ord, CAST(sum(CASE WHEN op IN ('M', 'I', 'S', 'H', '=', 'X') THEN len ELSE 0 END) AS INT) AS query_len,
       CAST(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) AS INT) AS ref_len, CAST(count(*) FILTER (WHERE op = 'D' AND len >= 2) AS INT) AS n_del_2
FROM walk GROUP BY qname, rec""",
    "read_strand": _ctes("fx_aln") + "SELECT qname, rec AS ord, CASE WHEN nh = 2 THEN false WHEN rec = 3 THEN true ELSE (flag & 16) <> 0 END AS is_rev FROM fx_aln",
    "filter_coverage": _ctes("fx_exon", "fx_aln", more=_SCORED) + f"SELECT qname, rec AS ord, CAST(covered AS INT) AS covered, score FROM judged WHERE {_COVERS}",
    "filter_identity": _ctes("fx_exon", "fx_aln", more=_SCORED) + f"SELECT qname, rec AS ord, CAST(covered AS INT) AS covered, score FROM judged WHERE {_ALIKE}",
    "filter_remove_overlap": _ctes("fx_exon", "fx_aln", more=_SCORED) + "SELECT qname, rec AS ord FROM outside",
    "best_alignment": _ctes("fx_exon", "fx_aln", more=_SCORED + _best("judged", 0)) + "SELECT qname, rec AS ord, score, CAST(second AS INT) AS second, CAST(n_introns AS INT) AS n_introns FROM best",
    "filter_full": _ctes("fx_exon", "fx_aln", more=_SCORED + _best("outside", 1)) + "SELECT qname, rec AS ord, score FROM best",
    "junction_extract": _ctes("fx_aln", more=_WALK) + "SELECT tid, CAST(here + 1 AS INT) AS don, CAST(here + len AS INT) AS acc, nh = 1 AS is_uniq, rec AS ord FROM walk WHERE op = 'N' AND len >= 3 AND (flag & 4) = 0 AND (flag & 2) <> 0",
    "junction_counts": _ctes("fx_aln", more=_WALK) + """SELECT tid, CAST(here + 1 AS INT) AS don, CAST(here + len AS INT) AS acc, 0 AS strand, 0 AS motif, CAST(count(*) FILTER (WHERE nh = 1) AS BIGINT) AS uniq_c,
       CAST(count(*) FILTER (WHERE nh <> 1) AS BIGINT) AS multi_c
FROM walk WHERE op = 'N' AND len >= 3 AND (flag & 4) = 0 AND (flag & 2) <> 0 GROUP BY 1, 2, 3""",
    "transcripts_nested": _ctes("fx_exon", more=_TR) + "SELECT ok AS ord, CAST(min(gene) AS VARCHAR) AS gene_id, min(tid) AS tid, string_agg(CAST(es AS VARCHAR), ',' ORDER BY j) AS starts, string_agg(CAST(ee AS VARCHAR), ',' ORDER BY j) AS ends FROM ex WHERE kind = 'read' GROUP BY ok",
    "transcript_extent": _ctes("fx_exon", more=_TR) + "SELECT ok AS ord, s AS t_start, e AS t_end, is_rev, CAST(n AS INT) AS n_exons FROM reads",
    "interval_overlap_join": _ctes("fx_exon", more=_PAIRS) + "SELECT r AS ord, a AS rank FROM pairs",
    "classify_compat": _ctes("fx_exon", more=_classified()) + "SELECT ok AS ord, class, known, shares AS has_known_site FROM named",
    "classify_fixed": _ctes("fx_exon", more=_classified(False)) + "SELECT ok AS ord, class, known, shares AS has_known_site FROM named",
    "ref_gene_assign": _ctes("fx_exon", more=_classified()) + "SELECT ok AS ord, coalesce(CAST(gene AS VARCHAR), 'NA') AS gene_id, is_rev FROM named",
    "novel_exons": _ctes("fx_exon", more=_classified()) + f"SELECT ok AS ord, {_FLAGS.format('novel')} AS flags FROM nexon GROUP BY ok",
    "novel_sites": _ctes("fx_exon", more=_classified()) + f"SELECT t.ok AS ord, {_FLAGS.format('novel_don')} AS donors, {_FLAGS.format('novel_acc')} AS acceptors FROM reads t LEFT JOIN nsite s ON s.ok = t.ok GROUP BY t.ok",
    "novel_junctions": _ctes("fx_exon", more=_classified()) + f"SELECT t.ok AS ord, {_FLAGS.format('novel')} AS flags FROM reads t LEFT JOIN njoint s ON s.ok = t.ok GROUP BY t.ok",
    "full_length_levels": _ctes("fx_exon", more=_ENDED) + "SELECT ok AS ord, l1 AND r1 AS full_1, l2 AND r2 AS full_2, (l2 OR NOT la) AND (r2 OR NOT ra) AS full_3, l2 OR NOT la AS full_4, true AS full_5 FROM ended",
    "full_gate": _ctes("fx_exon", more=_ENDED) + """SELECT CAST(k AS INT) AS level, e.ok AS ord FROM ended e JOIN named n ON n.ok = e.ok CROSS JOIN (VALUES (1), (2), (3), (4)) levels(k)
WHERE n.class = 'novel' AND CASE k WHEN 1 THEN l1 AND r1 WHEN 2 THEN l2 AND r2 WHEN 3 THEN (l2 OR NOT la) AND (r2 OR NOT ra) ELSE l2 OR NOT la END""",
    "distance_support": _ctes("fx_exon", "fx_sj", more=_classified()) + """SELECT j.ok AS ord, CAST(j.j AS INT) AS place, CAST(far AS INT) AS distance FROM njoint j JOIN reads t ON t.ok = j.ok CROSS JOIN (VALUES (2), (50)) f(far)
WHERE j.novel AND NOT EXISTS (SELECT 1 FROM fx_sj q WHERE q.tid = t.tid AND abs(q.don - (j.d + 1)) <= far AND abs(q.acc - (j.c - 1)) <= far AND q.uniq_c >= 1)""",
    "gtf_written": _ctes("fx_exon", more=_classified() + """, out_ AS (
  SELECT a.ok, CAST(a.ok AS VARCHAR) AS trans_id, a.gene, a.tid, a.is_rev FROM anno a UNION ALL SELECT n.ok, 'r' || CAST(n.ok AS VARCHAR), n.gene, n.tid, n.is_rev FROM named n WHERE n.class = 'novel'
)""") + """SELECT o.trans_id, CAST(any_value(o.gene) AS VARCHAR) AS gene_id, 'G' || CAST(any_value(o.gene) AS VARCHAR) AS gene_name, 'chr' || CAST(any_value(o.tid) + 1 AS VARCHAR) AS seqname,
       any_value(o.is_rev) AS is_rev, string_agg(CAST(x.es AS VARCHAR), ',' ORDER BY x.j) AS starts, string_agg(CAST(x.ee AS VARCHAR), ',' ORDER BY x.j) AS ends
FROM out_ o JOIN ex x ON x.ok = o.ok GROUP BY o.trans_id""",
    "sam_filtered": _ctes("fx_exon", "fx_aln", more=_SCORED + _best("judged", 0)) + "SELECT CAST(qname AS VARCHAR) AS qname, tid, pos, score, CAST(second AS INT) AS second, CAST(n_introns AS INT) AS n_introns FROM best",
    "single_exon_match": _ctes("fx_exon", more=_PAIRS) + f"SELECT r AS ord, a AS rank, {_FRACTION} >= CAST(0.8 AS FLOAT) AS is_known FROM pairs p JOIN ex x ON x.ok = p.r JOIN ex y ON y.ok = p.a WHERE p.n = 1 AND p.m = 1",
    "junction_support": _ctes("fx_exon", "fx_sj", more=_classified()) + """SELECT j.ok AS ord, CAST(j.j AS INT) AS place, t.tid, j.d + 1 AS don, j.c - 1 AS acc,
       EXISTS (SELECT 1 FROM fx_sj q WHERE q.tid = t.tid AND q.don = j.d + 1 AND q.acc = j.c - 1 AND q.uniq_c >= 1) AS supported
FROM njoint j JOIN reads t ON t.ok = j.ok WHERE j.novel""",
    "read_support": _ctes("fx_exon", "fx_sj", more=_JUDGED) + f"SELECT c.ok AS ord, any_value(tested) AS tested, any_value(unreliable) AS unreliable, coalesce(string_agg(CAST(CAST(coalesce(u.bad, false) AS INT) AS VARCHAR), '' ORDER BY j.j) FILTER (WHERE j.ok IS NOT NULL), '') AS flags FROM judged c LEFT JOIN njoint j ON j.ok = c.ok LEFT JOIN ujoint u ON u.ok = j.ok AND u.j = j.j GROUP BY c.ok",
    "split_pieces": _ctes("fx_exon", "fx_sj", more=_JUDGED + _PIECES) + "SELECT concat(CAST(ok AS VARCHAR), '.split.', CAST(piece AS VARCHAR)) AS trans_id, CAST(piece AS INT) AS piece, s AS t_start, e AS t_end, starts, ends FROM placed",
    "merge_identical_chain": _ctes("fx_exon", more=_TR + """, joint AS (SELECT x.ok, x.j, x.ee AS d, y.es AS c FROM ex x JOIN ex y ON y.ok = x.ok AND y.j = x.j + 1 WHERE x.kind = 'read'
), chain AS (SELECT ok, string_agg(CAST(d AS VARCHAR), ',' ORDER BY j) AS donors, string_agg(CAST(c AS VARCHAR), ',' ORDER BY j) AS acceptors FROM joint GROUP BY ok)""") + "SELECT tid, donors, acceptors, min(t.ok) AS ord, min(s) AS t_start, max(e) AS t_end, count(*) AS cov FROM chain JOIN reads t ON t.ok = chain.ok GROUP BY tid, donors, acceptors",
    "overlap_islands": _ctes("fx_exon", more=_TR + ", " + _ORDER.format("reads")) + "SELECT tid, island, count(*) AS n, max(e) AS island_end FROM heads GROUP BY tid, island",
    "novel_exon_bed": _ctes("fx_exon", "fx_sj", more=_JUDGED + """, found AS (
  SELECT c.ok, c.tid, x.j, x.es, x.ee, c.is_rev, CASE WHEN x.n = 1 THEN 'S' WHEN x.j = 0 OR x.j = x.n - 1 THEN 'T' ELSE 'I' END AS kind
  FROM judged c JOIN ex x ON x.ok = c.ok JOIN nexon e ON e.ok = x.ok AND e.j = x.j AND e.novel WHERE c.class = 'novel' AND NOT c.unreliable
)""") + "SELECT tid, es - 1 AS bed_start, ee AS bed_end, arg_min(kind, ok * 1000 + j) AS kind, CAST(count(*) AS BIGINT) AS score, arg_min(is_rev, ok * 1000 + j) AS is_rev FROM found GROUP BY tid, es, ee",
    "novel_site_counts": _ctes("fx_exon", "fx_sj", more=_JUDGED) + """SELECT kind, count(*) AS n FROM (
  SELECT DISTINCT 'donor' AS kind, c.tid, s.d AS site FROM judged c JOIN nsite s ON s.ok = c.ok WHERE c.class = 'novel' AND NOT c.unreliable AND s.novel_don
  UNION ALL SELECT DISTINCT 'acceptor', c.tid, s.c FROM judged c JOIN nsite s ON s.ok = c.ok WHERE c.class = 'novel' AND NOT c.unreliable AND s.novel_acc
) GROUP BY kind""",
    "novel_junction_counts": _ctes("fx_exon", "fx_sj", more=_JUDGED) + "SELECT c.tid, j.d AS don, j.c AS acc, count(*) AS n FROM judged c JOIN njoint j ON j.ok = c.ok WHERE c.class = 'novel' AND NOT c.unreliable AND j.novel GROUP BY 1, 2, 3",
    "class_summary": _ctes("fx_exon", "fx_sj", more=_JUDGED) + "SELECT CASE WHEN class = 'novel' THEN CASE WHEN unreliable THEN 'novel_unreliable' ELSE 'novel_reliable' END ELSE class END AS class, count(*) AS reads, count(DISTINCT gene) AS genes FROM judged GROUP BY 1",
    "detail_rows": _ctes("fx_exon", "fx_sj", more=_JUDGED + """, exon_list AS (
  SELECT x.ok, string_agg(CAST(x.es AS VARCHAR), ',' ORDER BY x.j) AS starts, string_agg(CAST(x.ee AS VARCHAR), ',' ORDER BY x.j) AS ends, count(*) AS n,
         count(*) FILTER (WHERE e.novel) AS n_exon, coalesce(string_agg(CAST(x.j AS VARCHAR), ',' ORDER BY x.j) FILTER (WHERE e.novel), 'NA') AS exon_index
  FROM ex x JOIN nexon e ON e.ok = x.ok AND e.j = x.j GROUP BY x.ok
), flat AS (SELECT ok, 2 * j AS k, novel_don AS novel FROM nsite UNION ALL SELECT ok, 2 * j + 1, novel_acc FROM nsite
), site_list AS (SELECT ok, count(*) AS n, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS places FROM flat WHERE novel GROUP BY ok
), joint_list AS (SELECT ok, count(*) AS n, string_agg(CAST(j AS VARCHAR), ',' ORDER BY j) AS places FROM njoint WHERE novel GROUP BY ok
), bad_list AS (SELECT ok, count(*) AS n, string_agg(CAST(j AS VARCHAR), ',' ORDER BY j) AS places FROM ujoint WHERE bad GROUP BY ok
)""") + """SELECT CAST(c.ok AS VARCHAR) AS trans_id, c.tid, CASE WHEN c.is_rev THEN '-' ELSE '+' END AS strand, CASE class WHEN 'known' THEN 0 WHEN 'novel' THEN 1 ELSE 2 END AS novel,
       coalesce(CAST(c.gene AS VARCHAR), 'NA') AS gene_id, CAST(e.n AS INT) AS n_exons, e.starts AS exon_starts, e.ends AS exon_ends, CAST(e.n_exon AS INT) AS n_exon, e.exon_index,
       CAST(coalesce(s.n, 0) AS INT) AS n_site, coalesce(s.places, 'NA') AS site_index, CAST(coalesce(j.n, 0) AS INT) AS n_junction, coalesce(j.places, 'NA') AS junction_index,
       CAST(coalesce(b.n, 0) AS INT) AS n_unreliable, coalesce(b.places, 'NA') AS unreliable_index
FROM judged c JOIN exon_list e ON e.ok = c.ok LEFT JOIN site_list s ON s.ok = c.ok LEFT JOIN joint_list j ON j.ok = c.ok LEFT JOIN bad_list b ON b.ok = c.ok""",
    "gene_run_count": _ctes("fx_exon", more=_TR + ", lagged AS (SELECT gene, lag(gene) OVER (ORDER BY ok) AS before FROM anno)") + "SELECT CAST(count(*) FILTER (WHERE before IS NULL OR before <> gene) AS BIGINT) AS runs, count(DISTINCT gene) AS genes FROM lagged",
    "gtf_sort_order": _ctes("fx_exon", more=_TR + """, named AS (
  SELECT ok, 'chr' || CAST(tid + 1 AS VARCHAR) AS seqname, tid, s, e FROM anno
), others AS (SELECT seqname, 25 + row_number() OVER (ORDER BY min(ok)) AS chr_ord FROM named WHERE tid >= 22 GROUP BY seqname
), keyed AS (SELECT n.*, coalesce(o.chr_ord, n.tid + 1) AS chr_ord FROM named n LEFT JOIN others o ON o.seqname = n.seqname)""") + """SELECT ok * 1000 AS ord, seqname, 'transcript' AS feature, CAST(chr_ord AS INT) AS chr_ord, s AS t_start, e AS t_end FROM keyed
UNION ALL SELECT k.ok * 1000 + x.j + 1, seqname, 'exon', CAST(chr_ord AS INT), k.s, k.e FROM keyed k JOIN ex x ON x.ok = k.ok""",
    "gtf_lines": _ctes("fx_exon", more=_TR + """, tagged AS (
  SELECT *, 'chr' || CAST(tid + 1 AS VARCHAR) AS c, CASE WHEN is_rev THEN '-' ELSE '+' END AS st, 'gene_id "' || CAST(gene AS VARCHAR) || '"; transcript_id "' || CAST(ok AS VARCHAR) || '";' AS ids FROM anno
)""") + """SELECT ok AS ord, 0 AS row, concat_ws(chr(9), c, 'src', 'transcript', CAST(s AS VARCHAR), CAST(e AS VARCHAR), '.', st, '.', ids || ' transcript_cov "1";') AS value FROM tagged
UNION ALL SELECT t.ok, CAST(CASE WHEN t.is_rev THEN t.n - x.j ELSE x.j + 1 END AS INT), concat_ws(chr(9), c, 'src', 'exon', CAST(x.es AS VARCHAR), CAST(x.ee AS VARCHAR), '.', st, '.', ids) FROM tagged t JOIN ex x ON x.ok = t.ok""",
    "union_annotation": _ctes("fx_exon", more=_classified()) + "SELECT ok AS ord, CAST(ok AS VARCHAR) AS trans_id, tid, CAST(n AS INT) AS n_exons, false AS is_new FROM anno UNION ALL SELECT ok, CAST(ok AS VARCHAR), tid, CAST(n AS INT), true FROM named WHERE class = 'novel'",
    "exon_union": _ctes("fx_exon", more="spans AS (SELECT tid, es AS s, ee AS e, ok FROM fx_exon), " + _ORDER.format("spans")) + "SELECT tid, island AS u_start, max(e) AS u_end, count(*) AS n FROM heads GROUP BY tid, island",
    "gene_extent": _ctes("fx_exon", more=_TR) + "SELECT CAST(gene AS VARCHAR) AS gene_id, tid, min(s) AS g_start, max(e) AS g_end, count(*) AS n_transcripts FROM anno GROUP BY gene, tid",
    "intron_motif": _ctes("fx_exon", "fx_sj") + "SELECT tid, don, acc, CAST(CASE (don + acc) % 8 WHEN 6 THEN 0 WHEN 7 THEN 0 ELSE (don + acc) % 8 + 1 END AS INT) AS motif FROM fx_sj",
    "fusion_segments": _ctes("fx_aln", more=_WALK + """, sums AS (
  SELECT qname, rec, min(tid) AS tid, min(flag) AS flag, min(pos) AS pos, CAST(sum(CASE WHEN op IN ('M', 'I', 'S', 'H', '=', 'X') THEN len ELSE 0 END) AS INT) AS rlen,
         CAST(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) AS INT) AS reflen, CAST(sum(CASE WHEN op IN ('M', 'I', '=', 'X') THEN len ELSE 0 END) AS INT) AS used,
         coalesce(max(CASE WHEN i = 1 AND op IN ('S', 'H') THEN len END), 0) AS head
  FROM walk GROUP BY qname, rec
)""") + """SELECT s.qname, s.rec AS ord, 0 AS score, q.nm AS ed, s.tid, (s.flag & 16) <> 0 AS is_rev, rlen,
       CASE WHEN (s.flag & 16) <> 0 THEN rlen + 1 - (head + used) ELSE head + 1 END AS read_start, CASE WHEN (s.flag & 16) <> 0 THEN rlen - head ELSE head + used END AS read_end,
       s.pos + 1 AS ref_start, s.pos + reflen AS ref_end
FROM sums s JOIN fx_aln q ON q.qname = s.qname AND q.rec = s.rec WHERE (s.flag & 4) = 0""",
    "fusion_pairs": _ctes("fx_seg", more=_RANKED) + "SELECT qname, first_ord, apart, apart_fixed, apart AND NOT close_by AS fits FROM fitted",
    "fusion_greedy": _ctes("fx_seg", more=_GREEDY).replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT qname, a.t AS left_tid, a.v AS left_is_rev, a.f AS left_ref_start, a.l AS left_ref_end,
       b.t AS right_tid, b.v AS right_is_rev, b.f AS right_ref_start, b.l AS right_ref_end FROM ended""",
    "merge_greedy": _ctes("fx_exon", more=_MERGED).replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT r.ok AS ord, r.grp AS tid, coalesce(l.s, r.x.s) AS t_start, coalesce(l.e, r.x.e) AS t_end, CAST(coalesce(l.cov, 1) AS INT) AS cov, r.absorbed
FROM held r LEFT JOIN survivors l ON l.ok = r.ok AND l.grp = r.grp""",
    "unique_shared": _ctes("fx_exon", more=_MERGED).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT ok AS ord, grp AS tid FROM held WHERE absorbed",
    "update_summary": _ctes("fx_exon", "fx_sj", more=_SUMMED).replace("WITH ", "WITH RECURSIVE ", 1)
    + " UNION ALL ".join([f"SELECT '{a}' AS section, '{b}' AS metric, CAST({c} AS BIGINT) AS value FROM {d}" for a, b, c, d in _SUMS] + [_UNIQUE]),
    "best_of_runs": _ctes("fx_exon", "fx_aln", more=_SCORED + f""", placed AS (
  SELECT *, rec % 2 * 10000000000 + qname * 100 + rec AS ord FROM judged WHERE {_COVERS} AND {_ALIKE}
), marked AS (SELECT *, CASE WHEN qname = lag(qname) OVER (ORDER BY ord) THEN 0 ELSE 1 END AS new FROM placed
), grouped AS (SELECT *, sum(new) OVER (ORDER BY ord) AS run FROM marked
), ranked AS (
  SELECT *, row_number() OVER w AS place, coalesce(lead(score) OVER w, 0) AS second FROM grouped WINDOW w AS (PARTITION BY run ORDER BY score DESC, ord)
)""") + """SELECT qname, CAST(run AS BIGINT) AS run, CAST(ord AS BIGINT) AS ord, score, CAST(second AS INT) AS second FROM ranked
WHERE place = 1 AND CAST(greatest(second, 0) AS FLOAT) < CAST(0.98 AS FLOAT) * CAST(score AS FLOAT)""",
    "bam_filtered": _ctes("fx_exon", "fx_aln", more=_SCORED + _best("judged", 0)) + "SELECT CAST(qname AS VARCHAR) AS qname, tid, pos, score, CAST(n_introns AS INT) AS n_introns FROM best",
    "genome_motifs": _ctes("fx_aln", more=_WALK + """, introns AS (
  SELECT tid, CAST(here + 1 AS BIGINT) AS don, CAST(here + len AS BIGINT) AS acc, count(*) FILTER (WHERE nh = 1) AS uniq_c, count(*) FILTER (WHERE nh <> 1) AS multi_c
  FROM walk WHERE op = 'N' AND len >= 3 AND (flag & 4) = 0 AND (flag & 2) <> 0 GROUP BY 1, 2, 3
), read_ AS (
  SELECT *, array_to_string(list_transform([don, don + 1, acc - 1, acc], lambda p: substr('GTAGCTACATATGCAGC', CAST((p * p + 3 * p + tid) % 17 + 1 AS INT), 1)), '') AS bases FROM introns
), numbered AS (SELECT *, coalesce(list_position(['GTAG', 'CTAC', 'GCAG', 'CTGC', 'ATAC', 'GTAT'], bases), 0) AS motif FROM read_)""")
    + "SELECT tid, CAST(don AS INT) AS don, CAST(acc AS INT) AS acc, CAST(CASE WHEN motif = 0 THEN 0 ELSE 2 - motif % 2 END AS INT) AS strand, CAST(motif AS INT) AS motif, uniq_c, multi_c FROM numbered",
    "exon_parts": _ctes("fx_exon", more=_TR + ", spans AS (SELECT tid, es AS s, ee AS e, ok FROM fx_exon), " + _ORDER.format("spans") + """, joined AS (SELECT tid, island AS s, max(e) AS e FROM heads GROUP BY tid, island
), sites AS (SELECT tid, ee + 1 AS p FROM ex WHERE j < n - 1 UNION SELECT tid, es FROM ex WHERE j > 0
), cuts AS (SELECT tid, s, e, s AS p FROM joined UNION ALL SELECT u.tid, u.s, u.e, q.p FROM joined u JOIN sites q ON q.tid = u.tid AND q.p > u.s AND q.p <= u.e)""")
    + "SELECT tid, CAST(p AS INT) AS p_start, CAST(coalesce(lead(p) OVER (PARTITION BY tid, s ORDER BY p) - 1, e) AS INT) AS p_end FROM cuts",
    "gene_gtf": _ctes("fx_exon", more=_TR + """, genes AS (
  SELECT gene, tid, min(ok) AS gene_ord, min(s) AS s, max(e) AS e, arg_min(is_rev, ok) AS is_rev FROM anno GROUP BY gene, tid
), tagged AS (
  SELECT a.*, g.gene_ord, 'chr' || CAST(a.tid + 1 AS VARCHAR) AS c, CASE WHEN a.is_rev THEN '-' ELSE '+' END AS st,
         'gene_id "' || CAST(a.gene AS VARCHAR) || '"; transcript_id "' || CAST(ok AS VARCHAR) || '"; gene_name "G' || CAST(a.gene AS VARCHAR) || '";' AS ids
  FROM anno a JOIN genes g ON g.gene = a.gene AND g.tid = a.tid
)""") + """SELECT gene_ord, gene_ord AS ord, -1 AS row, concat_ws(chr(9), 'chr' || CAST(tid + 1 AS VARCHAR), 'src', 'gene', CAST(s AS VARCHAR), CAST(e AS VARCHAR), '.', CASE WHEN is_rev THEN '-' ELSE '+' END, '.',
       'gene_id "' || CAST(gene AS VARCHAR) || '"; gene_name "G' || CAST(gene AS VARCHAR) || '";') AS value FROM genes
UNION ALL SELECT gene_ord, ok, 0, concat_ws(chr(9), c, 'src', 'transcript', CAST(s AS VARCHAR), CAST(e AS VARCHAR), '.', st, '.', ids) FROM tagged
UNION ALL SELECT gene_ord, t.ok, CAST(CASE WHEN t.is_rev THEN t.n - x.j ELSE x.j + 1 END AS INT), concat_ws(chr(9), c, 'src', 'exon', CAST(x.es AS VARCHAR), CAST(x.ee AS VARCHAR), '0', st, '.', ids) FROM tagged t JOIN ex x ON x.ok = t.ok""",
    "region_read": _ctes("fx_aln", more=_WALK + """, spans AS (
  SELECT qname, rec, min(tid) AS tid, min(pos) AS pos, min(pos) + sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) - 1 AS last FROM walk WHERE (flag & 4) = 0 GROUP BY qname, rec
)""") + "SELECT qname, rec, pos, CAST(last AS INT) AS last FROM spans WHERE tid = 3 AND pos <= 9000 AND last >= 5000",
    "junction_file": _ctes("fx_aln", more=_WALK + """, counts AS (
  SELECT tid, CAST(here + 1 AS INT) AS don, CAST(here + len AS INT) AS acc, count(*) FILTER (WHERE nh = 1) AS uniq_c, count(*) FILTER (WHERE nh <> 1) AS multi_c
  FROM walk WHERE op = 'N' AND len >= 3 AND (flag & 4) = 0 AND (flag & 2) <> 0 GROUP BY 1, 2, 3
)""")
    + "SELECT 'chr' || CAST(tid + 1 AS VARCHAR) AS chrom, CASE WHEN tid < 24 THEN tid END AS tid, don, acc, CAST(uniq_c AS INT) AS uniq_c, CAST(multi_c AS INT) AS multi_c FROM counts",
    "junction_order": _ctes("fx_aln", more=_WALK + """, counts AS (
  SELECT tid, CAST(here + 1 AS INT) AS don, CAST(here + len AS INT) AS acc, count(*) FILTER (WHERE nh = 1) AS uniq_c, count(*) FILTER (WHERE nh <> 1) AS multi_c
  FROM walk WHERE op = 'N' AND len >= 3 AND (flag & 4) = 0 AND (flag & 2) <> 0 GROUP BY 1, 2, 3
)""") + """SELECT CAST(k AS BIGINT) AS place, value FROM (VALUES (1, '###STRAND 0:undefined, 1:+, 2:-'), (2, '###ANNO 0:novel, 1:annotated'),
  (3, '###MOTIF 0:non-canonical, 1:GT/AG, 2:CT/AC, 3:GC/AG, 4:CT/GC, 5:AT/AC, 6:GT/AT'), (4, '#CHR' || chr(9) || 'START' || chr(9) || 'END' || chr(9) || 'STRAND' || chr(9) || 'ANNO' || chr(9) || 'UNIQ_C' || chr(9) || 'MULTI_C' || chr(9) || 'MOTIF')) h(k, value)
UNION ALL SELECT 4 + row_number() OVER (ORDER BY tid, don, acc), concat_ws(chr(9), 'chr' || CAST(tid + 1 AS VARCHAR), CAST(don AS VARCHAR), CAST(acc AS VARCHAR), '0', '1', CAST(uniq_c AS VARCHAR), CAST(multi_c AS VARCHAR), '0') FROM counts""",
    "gtf_odd": _ctes("fx_exon", more=_TR) + """SELECT 't' || CAST(ok AS VARCHAR) AS trans_id, 't' || CAST(ok AS VARCHAR) AS trans_name, CAST(gene AS VARCHAR) AS gene_id, CAST(gene AS VARCHAR) AS gene_name,
       CAST(CASE WHEN tid < 24 THEN tid ELSE -1 END AS INT) AS tid, CAST(n AS INT) AS n_exons, is_rev FROM anno""",
}
