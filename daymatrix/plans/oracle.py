"""DuckDB oracle SQL, one statement per registered job.

Each statement re-derives the expected result from the raw driver views
(``orders``, ``customer``, ``nation``, ``lineitem``, ``events``) in plain SQL:
the fixture views, the cleaning rules, the range tables (as ``VALUES`` with a
range join and ``arg_min``), the counts, fills and renderings. Wide results
name their columns (``plans.features``), one filtered sum each.
"""

from __future__ import annotations

import datetime as dt

from daymatrix.functions.clean import WHITESPACE
from daymatrix.functions.icd import CHAPTER_RANGES, SELECTED_CODES, SUBCHAPTER_RANGES
from daymatrix.operators.demand import DEMAND_VARIABLES
from daymatrix.plans import catalog as C
from daymatrix.schema import VISIT_COLUMNS
from daymatrix.plans import features as names

# --- SQL text helpers ----------------------------------------------------------

_WS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def _ts(d: dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def strip(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {_WS})"


def clean(x: str) -> str:
    return f"COALESCE(NULLIF({strip(x)}, ''), 'NA')"


def pad(x: str) -> str:
    s = f"NULLIF({strip(x)}, '')"
    return (f"(CASE WHEN {s} IS NULL THEN NULL WHEN length({s}) >= 5 THEN {s} "
            f"WHEN regexp_matches({s}, '^[+-]') THEN substr({s}, 1, 1) || lpad(substr({s}, 2), 4, '0') "
            f"ELSE lpad({s}, 5, '0') END)")


def ordinal(x: str) -> str:
    return f"((ascii(substr({x}, 1, 1)) - 65) * 100 + CAST(substr({x}, 2, 2) AS INTEGER))"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


SELECTED_SQL = ", ".join(f"'{c}'" for c in sorted(set(SELECTED_CODES)))

# --- fixture views (FIXTURES.md section 3) ---------------------------------------

FIXTURES = """
visits AS (
  SELECT o_orderdate AS DATA_VISITA,
         CASE WHEN o_orderkey % 43 = 0 THEN 'U' ELSE '' END || CAST(o_custkey AS VARCHAR) AS UP,
         o_orderstatus AS VISI_LLOC_VISITA,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN '  '
              ELSE substr(o_orderpriority, 1, 1) END AS VISI_SITUACIO_VISITA,
         o_orderpriority AS SERVEI_CODI,
         CASE o_orderkey % 9 WHEN 0 THEN 'C9C' WHEN 1 THEN ' c9r ' WHEN 2 THEN 'CALTRE'
              WHEN 3 THEN 'D9D' WHEN 4 THEN 'dALTRE' WHEN 5 THEN '9T' WHEN 6 THEN ''
              WHEN 7 THEN 'ZZ' END AS TIPUS_CLASS,
         o_orderstatus AS VISI_TIPUS_VISITA
  FROM orders),
up_rs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS codi_up,
         CASE WHEN c_custkey % 17 = 0 THEN '  '
              WHEN c_custkey % 23 = 0 THEN 'SENSEESPECIFICAR_SE'
              WHEN c_custkey % 29 = 0 THEN NULL
              ELSE 'RS' || CAST(n_regionkey AS VARCHAR) END AS RS
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
diagnoses AS (
  SELECT l_shipdate AS data_visita,
         CASE WHEN l_orderkey % 43 = 0 THEN 'U' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS up_c,
         CASE WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 53 = 0 THEN 'x?'
              WHEN l_orderkey % 7 = 0 THEN upper(substr('abcdefghijklmnopqrstuvwxyz', CAST(l_partkey % 26 AS INT) + 1, 1))
                   || lpad(CAST(l_orderkey % 100 AS VARCHAR), 2, '0')
              ELSE substr('abcdefghijklmnopqrstuvwxyz', CAST(l_partkey % 26 AS INT) + 1, 1)
                   || lpad(CAST(l_orderkey % 100 AS VARCHAR), 2, '0')
                   || '.' || CAST(l_linenumber AS VARCHAR) END AS problema_salut_c
  FROM lineitem)"""

LOOKUP = f"""
lk AS (
  SELECT UP, min(RS) AS RS FROM (
    SELECT {pad('codi_up')} AS UP, NULLIF({strip('RS')}, '') AS RS FROM up_rs) t
  WHERE UP IS NOT NULL GROUP BY UP)"""

VISITS_CLEAN = f"""
vc AS (
  SELECT CAST(DATA_VISITA AS DATE) AS day,
         COALESCE({pad('UP')}, 'NA') AS UP,
         {clean('VISI_LLOC_VISITA')} AS VISI_LLOC_VISITA,
         {clean('VISI_SITUACIO_VISITA')} AS VISI_SITUACIO_VISITA,
         {clean('SERVEI_CODI')} AS SERVEI_CODI,
         upper({clean('TIPUS_CLASS')}) AS TIPUS_CLASS
  FROM visits WHERE DATA_VISITA IS NOT NULL),
vp AS (
  SELECT vc.day, vc.UP, vc.VISI_LLOC_VISITA, vc.VISI_SITUACIO_VISITA, vc.SERVEI_CODI, vc.TIPUS_CLASS,
         CASE WHEN vc.TIPUS_CLASS IN ('C9C', 'C9R', 'CALTRE') THEN 'PRESENCIAL'
              WHEN vc.TIPUS_CLASS IN ('D9D', 'DALTRE') THEN 'DOMICILIARIA'
              WHEN vc.TIPUS_CLASS = '9T' THEN 'TELEFONICA' ELSE 'NA' END AS TIPUS_VISITA_AGRUPAT,
         CASE WHEN lk.RS IS NULL OR lk.RS = 'SENSEESPECIFICAR_SE' THEN 'RS:SENSEESPECIFICAR_SE'
              ELSE lk.RS END AS RS
  FROM vc LEFT JOIN lk ON vc.UP = lk.UP)"""

_stack_rows = "\n  UNION ALL ".join(
    [f"SELECT day, RS, UP, 'TOTAL' AS variable, CAST(NULL AS VARCHAR) AS value FROM vp"]
    + [f"SELECT day, RS, UP, '{v}', {v} FROM vp" for v in DEMAND_VARIABLES]
)
DEMAND_STACK = f"""
dst AS (
  {_stack_rows})"""

DIAG_PARSE = f"""
dpar AS (
  SELECT CAST(data_visita AS DATE) AS DATA_VISITA, {pad('up_c')} AS UP, problema_salut_c AS DIAG_CODE,
         regexp_replace(upper({strip('problema_salut_c')}), '[^A-Z0-9]', '', 'g') AS alnum
  FROM diagnoses),
dnorm AS (
  SELECT *, CASE WHEN regexp_matches(alnum, '^[A-Z][0-9]{{2}}') THEN alnum END AS ICD10_CODE FROM dpar)"""

DIAG_REDUCED = f"""
dred AS (
  SELECT DATA_VISITA, UP, substr(ICD10_CODE, 1, 3) AS ICD10_3, count(*) AS n
  FROM dnorm WHERE DATA_VISITA IS NOT NULL AND UP IS NOT NULL AND ICD10_CODE IS NOT NULL
  GROUP BY 1, 2, 3),
chap AS (SELECT * FROM (VALUES {_values([(i, n, lo, hi) for i, (n, lo, hi) in enumerate(CHAPTER_RANGES)])}) t(priority, name, lo, hi)),
subc AS (SELECT * FROM (VALUES {_values([(i, n, lo, hi) for i, (n, lo, hi) in enumerate(SUBCHAPTER_RANGES)])}) t(priority, name, lo, hi)),
codes AS (SELECT DISTINCT ICD10_3 FROM dred),
cmap AS (SELECT c.ICD10_3, arg_min(r.name, r.priority) AS nm FROM codes c JOIN chap r
         ON {ordinal('c.ICD10_3')} BETWEEN {ordinal('r.lo')} AND {ordinal('r.hi')} GROUP BY c.ICD10_3),
smap AS (SELECT c.ICD10_3, arg_min(r.name, r.priority) AS nm FROM codes c JOIN subc r
         ON {ordinal('c.ICD10_3')} BETWEEN {ordinal('r.lo')} AND {ordinal('r.hi')} GROUP BY c.ICD10_3),
dx AS (
  SELECT d.DATA_VISITA, d.UP, d.ICD10_3, COALESCE(lk.RS, 'RS:SENSEESPECIFICAR_SE') AS RS,
         COALESCE(cmap.nm, 'UNKNOWN') AS ICD10_CHAPTER, COALESCE(smap.nm, 'UNKNOWN') AS ICD10_SUBCHAPTER,
         d.n
  FROM dred d LEFT JOIN lk ON d.UP = lk.UP
  LEFT JOIN cmap ON d.ICD10_3 = cmap.ICD10_3 LEFT JOIN smap ON d.ICD10_3 = smap.ICD10_3)"""

DIAG_STACK = f"""
xst AS (
  SELECT DATA_VISITA AS day, RS, UP, 'TOTAL' AS variable, CAST(NULL AS VARCHAR) AS value, n FROM dx
  UNION ALL SELECT DATA_VISITA, RS, UP, 'ICD10_CHAPTER', ICD10_CHAPTER, n FROM dx
  UNION ALL SELECT DATA_VISITA, RS, UP, 'ICD10_SUBCHAPTER', ICD10_SUBCHAPTER, n FROM dx
  UNION ALL SELECT DATA_VISITA, RS, UP, 'ICD10_3', ICD10_3, n FROM dx WHERE ICD10_3 IN ({SELECTED_SQL}))"""

RAW_ROWS = f"""
rr AS (
  SELECT CAST(data_visita AS DATE) AS day, {pad('up_c')} AS UP, {strip('problema_salut_c')} AS DIAG_CODE
  FROM diagnoses WHERE data_visita IS NOT NULL AND problema_salut_c IS NOT NULL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join([FIXTURES, *ctes]) + "\n"


DEMAND_BASE = (LOOKUP, VISITS_CLEAN, DEMAND_STACK)
DIAG_BASE = (LOOKUP, DIAG_PARSE, DIAG_REDUCED)
ALL_BASE = (LOOKUP, VISITS_CLEAN, DEMAND_STACK, DIAG_PARSE, DIAG_REDUCED)


def scoped(src: str, domain: str, scopes=("CAT", "RS", "UP"), where: str = "TRUE", measure: str = "count(*)") -> str:
    parts = []
    for s in scopes:
        g = {"CAT": "CAST(NULL AS VARCHAR)", "RS": "RS", "UP": "UP"}[s]
        keys = "day, variable, value" if s == "CAT" else f"day, {g}, variable, value"
        parts.append(f"SELECT day, '{domain}' AS domain, '{s}' AS scope, {g} AS group_value, variable, value, "
                     f"CAST({measure} AS BIGINT) AS n FROM {src} WHERE {where} GROUP BY {keys}")
    return "\n  UNION ALL ".join(parts)


DEMAND_NAME = """CASE WHEN scope = 'CAT' AND variable = 'TOTAL' THEN 'demanda__TOTAL_CAT'
     WHEN scope = 'CAT' THEN 'demanda__' || variable || '__' || value
     WHEN variable = 'TOTAL' THEN 'demanda__TOTAL_' || scope || '_' || group_value
     ELSE 'demanda_' || variable || '_' || value || '_' || group_value END"""
_DIAG_PREFIX = ("(CASE variable WHEN 'ICD10_CHAPTER' THEN 'CHAPTER' WHEN 'ICD10_SUBCHAPTER' THEN 'SUBCHAPTER' "
                "ELSE variable END)")
DIAG_NAME = f"""CASE WHEN scope = 'CAT' AND variable = 'TOTAL' THEN 'TOTAL'
     WHEN scope = 'CAT' THEN {_DIAG_PREFIX} || '_' || value
     WHEN variable = 'TOTAL' THEN 'TOTAL__' || scope || '__' || group_value
     ELSE {_DIAG_PREFIX} || '__' || value || '__' || scope || '__' || group_value END"""


def demand_long(scopes=("CAT", "RS", "UP"), where="TRUE") -> str:
    return f"dlong AS ({scoped('dst', 'demand', scopes, where)})"


def diag_long(scopes=("CAT", "RS", "UP"), where="TRUE") -> str:
    return f"xlong AS ({scoped('xst', 'diagnosis', scopes, where, 'sum(n)')})"


def pivot(src: str, columns, key: str = "day", fill: bool = True, extra: str = "") -> str:
    cells = []
    for c in columns:
        total = f"CAST(sum(n) FILTER (WHERE feature = '{c}') AS BIGINT)"
        cells.append((f"COALESCE({total}, 0)" if fill else total) + f' AS "{c}"')
    return f"SELECT {extra}{key} AS timestamp, {', '.join(cells)} FROM {src} GROUP BY {key}"


def cells(src: str, columns, name: str = "feature", value: str = "n") -> str:
    """The cells of a zero-filled matrix as rows."""
    return (f"SELECT d.day AS timestamp, f.feature AS {name}, CAST(COALESCE(sum(s.n), 0) AS BIGINT) AS {value} "
            f"FROM (SELECT DISTINCT day FROM {src}) d CROSS JOIN (VALUES {_values([(c,) for c in columns])}) f(feature) "
            f"LEFT JOIN {src} s ON s.day = d.day AND s.feature = f.feature GROUP BY 1, 2")


def calendar(name: str, bounds: str) -> str:
    return (f"{name} AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), "
            f"INTERVAL 1 DAY)) AS DATE) AS day FROM {bounds})")


SQL: dict[str, str] = {}

# --- scans -------------------------------------------------------------------------

SQL["scan_range"] = with_() + f"""SELECT DATA_VISITA, UP, SERVEI_CODI FROM visits
WHERE DATA_VISITA >= {_ts(C.SCAN_LO)} AND DATA_VISITA < {_ts(C.SCAN_HI)}"""

SQL["scan_after_watermark"] = with_() + f"""SELECT DATA_VISITA, UP, SERVEI_CODI FROM visits
WHERE DATA_VISITA >= {_ts(C.SCAN_LO)} AND DATA_VISITA < {_ts(C.SCAN_HI)} AND DATA_VISITA > {_ts(C.SCAN_AFTER)}"""

SQL["scan_diagnosis_not_null"] = with_() + f"""SELECT data_visita AS DATA_VISITA, up_c AS UP, problema_salut_c AS DIAG_CODE
FROM diagnoses WHERE problema_salut_c IS NOT NULL
  AND data_visita >= {_ts(C.DIAG_SCAN_LO)} AND data_visita < {_ts(C.DIAG_SCAN_HI)}"""

SQL["date_bounds"] = with_() + f"""SELECT CAST(min(DATA_VISITA) AS DATE) AS min_date, CAST(max(DATA_VISITA) AS DATE) AS max_date
FROM visits WHERE DATA_VISITA IS NOT NULL AND DATA_VISITA >= {_ts(C.MIN_VALID)}
  AND DATA_VISITA < {_ts(C.AS_OF + dt.timedelta(days=1))}"""

SQL["year_ranges"] = with_() + """SELECT CAST(y AS INTEGER) AS year, make_date(CAST(y AS INTEGER), 1, 1) AS year_start,
       make_date(CAST(y AS INTEGER) + 1, 1, 1) AS year_end
FROM (SELECT unnest(generate_series(year(min(CAST(DATA_VISITA AS DATE))), year(max(CAST(DATA_VISITA AS DATE))))) AS y
      FROM visits) t"""

SQL["lookup_up_rs"] = with_(LOOKUP, VISITS_CLEAN) + """SELECT lk.UP,
       CASE WHEN lk.RS IS NULL OR lk.RS = 'SENSEESPECIFICAR_SE' THEN 'RS:SENSEESPECIFICAR_SE' ELSE lk.RS END AS RS,
       CAST(COALESCE(u.n_visits, 0) AS BIGINT) AS n_visits
FROM lk LEFT JOIN (SELECT UP, count(*) AS n_visits FROM vc GROUP BY UP) u ON lk.UP = u.UP"""

SQL["selected_codes"] = with_(*DIAG_BASE) + f"""SELECT s.ICD10_3, CAST(COALESCE(u.n, 0) AS BIGINT) AS n
FROM (VALUES {_values([(c,) for c in sorted(set(SELECTED_CODES))])}) s(ICD10_3)
LEFT JOIN (SELECT ICD10_3, sum(n) AS n FROM dx GROUP BY ICD10_3) u ON s.ICD10_3 = u.ICD10_3"""

# --- cleaning ------------------------------------------------------------------------

SQL["pad_unit_code"] = with_() + f"""SELECT UP_RAW, {pad('UP_RAW')} AS UP, n
FROM (SELECT UP AS UP_RAW, count(*) AS n FROM visits GROUP BY UP) t"""

SQL["clean_labels"] = with_() + f"""SELECT {clean('VISI_LLOC_VISITA')} AS VISI_LLOC_VISITA,
       {clean('VISI_SITUACIO_VISITA')} AS VISI_SITUACIO_VISITA, {clean('SERVEI_CODI')} AS SERVEI_CODI,
       count(*) AS n
FROM visits GROUP BY 1, 2, 3"""

SQL["visit_class"] = with_() + f"""SELECT TIPUS_CLASS AS TIPUS_CLASS_RAW, upper({clean('TIPUS_CLASS')}) AS TIPUS_CLASS, count(*) AS n
FROM visits GROUP BY 1, 2"""

SQL["visit_class_group"] = with_() + f"""SELECT TIPUS_CLASS,
       CASE WHEN TIPUS_CLASS IN ('C9C', 'C9R', 'CALTRE') THEN 'PRESENCIAL'
            WHEN TIPUS_CLASS IN ('D9D', 'DALTRE') THEN 'DOMICILIARIA'
            WHEN TIPUS_CLASS = '9T' THEN 'TELEFONICA' ELSE 'NA' END AS TIPUS_VISITA_AGRUPAT,
       count(*) AS n
FROM (SELECT upper({clean('TIPUS_CLASS')}) AS TIPUS_CLASS FROM visits) v GROUP BY 1, 2"""

SQL["region_default"] = with_(LOOKUP, VISITS_CLEAN) + "SELECT RS, count(*) AS n FROM vp GROUP BY RS"
SQL["visits_by_day"] = with_(LOOKUP, VISITS_CLEAN) + "SELECT day, count(*) AS n FROM vc GROUP BY day"
SQL["visits_with_region"] = with_(LOOKUP, VISITS_CLEAN) + "SELECT UP, RS, count(*) AS n FROM vp GROUP BY UP, RS"

# --- ICD-10 --------------------------------------------------------------------------

SQL["icd_normalize"] = with_(DIAG_PARSE) + "SELECT DIAG_CODE, ICD10_CODE, count(*) AS n FROM dnorm GROUP BY 1, 2"
SQL["icd_code3_search"] = with_(DIAG_PARSE) + """SELECT DIAG_CODE, NULLIF(regexp_extract(alnum, '[A-Z][0-9]{2}', 0), '') AS ICD10_3,
       count(*) AS n FROM dnorm GROUP BY 1, 2"""
SQL["icd_code3_prefix"] = with_(DIAG_PARSE) + "SELECT DIAG_CODE, substr(ICD10_CODE, 1, 3) AS ICD10_3, count(*) AS n FROM dnorm GROUP BY 1, 2"
SQL["icd_ordinal"] = with_(DIAG_PARSE) + f"""SELECT ICD10_3, {ordinal('ICD10_3')} AS ordinal, count(*) AS n
FROM (SELECT NULLIF(regexp_extract(alnum, '[A-Z][0-9]{{2}}', 0), '') AS ICD10_3 FROM dnorm) t GROUP BY 1, 2"""
SQL["icd_chapter"] = with_(*DIAG_BASE) + "SELECT ICD10_3, ICD10_CHAPTER, CAST(sum(n) AS BIGINT) AS n FROM dx GROUP BY 1, 2"
SQL["icd_subchapter"] = with_(*DIAG_BASE) + "SELECT ICD10_3, ICD10_SUBCHAPTER, CAST(sum(n) AS BIGINT) AS n FROM dx GROUP BY 1, 2"

# --- demand counts -------------------------------------------------------------------

_TOTAL, _FEATS = "variable = 'TOTAL'", "variable <> 'TOTAL'"
for _key, _scopes, _where in [
    ("demand_total_cat", ("CAT",), _TOTAL), ("demand_total_rs", ("RS",), _TOTAL), ("demand_total_up", ("UP",), _TOTAL),
    ("demand_features_cat", ("CAT",), _FEATS), ("demand_features_rs", ("RS",), _FEATS),
    ("demand_features_up", ("UP",), _FEATS), ("demand_all_scopes", ("CAT", "RS", "UP"), "TRUE"),
]:
    SQL[_key] = with_(*DEMAND_BASE) + scoped("dst", "demand", _scopes, _where)

SQL["demand_feature_names"] = with_(*DEMAND_BASE, demand_long()) + f"SELECT day, {DEMAND_NAME} AS feature, n FROM dlong"

_DCAT = f"dcat AS (SELECT day, {DEMAND_NAME} AS feature, n FROM ({scoped('dst', 'demand', ('CAT',))}) t)"
_DRS = f"drs AS (SELECT day, {DEMAND_NAME} AS feature, n FROM ({scoped('dst', 'demand', ('RS',))}) t)"
SQL["demand_wide_cat"] = with_(*DEMAND_BASE, _DCAT) + pivot("dcat", names.demand_features("CAT"))
SQL["demand_wide_rs"] = with_(*DEMAND_BASE, _DRS) + pivot("drs", names.demand_features("RS"))
SQL["wide_to_long"] = with_(*DEMAND_BASE, _DCAT) + cells("dcat", names.demand_features("CAT"))

# --- diagnosis -----------------------------------------------------------------------

SQL["diagnosis_prepared"] = with_(*DIAG_BASE) + "SELECT * FROM dx"
SQL["diagnosis_total"] = with_(*DIAG_BASE) + "SELECT DATA_VISITA, CAST(sum(n) AS BIGINT) AS DIAG_TOTAL FROM dx GROUP BY 1"
SQL["diagnosis_total_rs"] = with_(*DIAG_BASE, "tr AS (SELECT DATA_VISITA, 'DIAG_TOTAL__RS__' || RS AS feature, n FROM dx)") \
    + pivot("tr", [f"DIAG_TOTAL__RS__{r}" for r in names.DIAGNOSIS_REGIONS], "DATA_VISITA")
SQL["diagnosis_code_daily"] = with_(RAW_ROWS) + "SELECT day, DIAG_CODE, count(*) AS n FROM rr GROUP BY 1, 2"
SQL["diagnosis_code_by_group"] = with_(LOOKUP, RAW_ROWS) + """SELECT day, COALESCE(lk.RS, 'UNKNOWN') AS RS, DIAG_CODE, count(*) AS n
FROM rr LEFT JOIN lk ON rr.UP = lk.UP GROUP BY 1, 2, 3"""
SQL["diagnosis_feature_names"] = with_(*DIAG_BASE, DIAG_STACK, diag_long()) + f"SELECT day, {DIAG_NAME} AS feature, n FROM xlong"
SQL["selected_raw_codes"] = with_(RAW_ROWS) + f"""SELECT day, DIAG_CODE, count(*) AS n FROM rr
WHERE DIAG_CODE IN ({", ".join(repr(c) for c in SELECTED_CODES)}) GROUP BY 1, 2"""

SQL["grouped_long_chapter_cat"] = with_(*DIAG_BASE) + """SELECT DATA_VISITA, ICD10_CHAPTER, CAST(sum(n) AS BIGINT) AS n,
       'ICD10_CHAPTER' AS LEVEL FROM dx GROUP BY 1, 2"""
SQL["grouped_long_subchapter_rs"] = with_(*DIAG_BASE) + """SELECT DATA_VISITA, RS, ICD10_SUBCHAPTER, CAST(sum(n) AS BIGINT) AS n,
       'ICD10_SUBCHAPTER' AS LEVEL FROM dx GROUP BY 1, 2, 3"""
SQL["grouped_long_code_up"] = with_(*DIAG_BASE) + """SELECT DATA_VISITA, UP, ICD10_3, CAST(sum(n) AS BIGINT) AS n,
       'ICD10_3' AS LEVEL FROM dx GROUP BY 1, 2, 3"""

_XCAT = f"xcat AS (SELECT day, {DIAG_NAME} AS feature, n FROM ({scoped('xst', 'diagnosis', ('CAT',), 'TRUE', 'sum(n)')}) t)"
_IS_CHAPTER = "variable = 'ICD10_CHAPTER'"
_CH_CAT = f"chc AS (SELECT day, {DIAG_NAME} AS feature, n FROM ({scoped('xst', 'diagnosis', ('CAT',), _IS_CHAPTER, 'sum(n)')}) t)"
_CH_RS = f"chr_ AS (SELECT day, {DIAG_NAME} AS feature, n FROM ({scoped('xst', 'diagnosis', ('RS',), _IS_CHAPTER, 'sum(n)')}) t)"
SQL["wide_chapter_cat"] = with_(*DIAG_BASE, DIAG_STACK, _CH_CAT) + pivot("chc", names.diagnosis_features("CAT", ["ICD10_CHAPTER"], False))
SQL["wide_chapter_rs"] = with_(*DIAG_BASE, DIAG_STACK, _CH_RS) + pivot("chr_", names.diagnosis_features("RS", ["ICD10_CHAPTER"], False))
SQL["diagnosis_code_wide"] = with_(*DIAG_BASE) + pivot(
    f"(SELECT DATA_VISITA AS day, 'DIAG_CODE_' || ICD10_3 AS feature, n FROM dx WHERE ICD10_3 IN ({SELECTED_SQL}))",
    [f"DIAG_CODE_{c}" for c in sorted(set(SELECTED_CODES))])
SQL["selected_daily_cat"] = with_(*DIAG_BASE) + pivot(
    f"(SELECT DATA_VISITA AS day, 'ICD10_3__' || ICD10_3 AS feature, n FROM dx WHERE ICD10_3 IN ({SELECTED_SQL}))",
    [f"ICD10_3__{c}" for c in sorted(set(SELECTED_CODES))])
SQL["selected_daily_rs"] = with_(*DIAG_BASE) + pivot(
    f"(SELECT DATA_VISITA AS day, 'ICD10_3__' || ICD10_3 || '__RS__' || RS AS feature, n FROM dx "
    f"WHERE ICD10_3 IN ({SELECTED_SQL}))", names.diagnosis_features("RS", ["ICD10_3"], False))
SQL["selected_wide_cat"] = with_(*DIAG_BASE, DIAG_STACK, _XCAT) + pivot("xcat", names.diagnosis_features("CAT"))
SQL["selected_wide_rs"] = with_(*DIAG_BASE, DIAG_STACK, diag_long(("RS",))) + pivot(
    f"(SELECT day, {DIAG_NAME} AS feature, n FROM xlong)", names.diagnosis_features("RS"))
SQL["selected_long_up"] = with_(*DIAG_BASE, DIAG_STACK, diag_long(("UP",))) + f"SELECT day, {DIAG_NAME} AS feature, n FROM xlong"

# --- time series -----------------------------------------------------------------------

SQL["densify_total_cat"] = with_(*DEMAND_BASE, "t AS (SELECT day, count(*) AS n FROM vp GROUP BY day)",
                                 "b AS (SELECT min(day) AS lo, max(day) AS hi FROM t)", calendar("cal", "b")) + \
    """SELECT cal.day AS timestamp, CAST(COALESCE(t.n, 0) AS BIGINT) AS "demanda__TOTAL_CAT" FROM cal LEFT JOIN t ON cal.day = t.day"""

SQL["densify_features_rs"] = with_(*DEMAND_BASE, _DRS, "b AS (SELECT min(day) AS lo, max(day) AS hi FROM drs)",
                                   calendar("cal", "b")) + \
    """SELECT f.feature, cal.day, CAST(COALESCE(drs.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT feature FROM drs) f CROSS JOIN cal
LEFT JOIN drs ON drs.feature = f.feature AND drs.day = cal.day"""

_SPARSE = (*DIAG_BASE, DIAG_STACK, _CH_CAT, "b AS (SELECT min(day) AS lo, max(day) AS hi FROM chc)",
           calendar("cal", "b"),
           """g AS (SELECT f.feature, cal.day, chc.n FROM (SELECT DISTINCT feature FROM chc) f CROSS JOIN cal
  LEFT JOIN chc ON chc.feature = f.feature AND chc.day = cal.day)""")
_W_BEFORE = "OVER (PARTITION BY feature ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_W_AFTER = "OVER (PARTITION BY feature ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
SQL["fill_forward"] = with_(*_SPARSE) + f"""SELECT feature, day,
       CAST(COALESCE(last_value(n IGNORE NULLS) {_W_BEFORE}, 0) AS BIGINT) AS n FROM g"""
SQL["fill_backward"] = with_(*_SPARSE) + f"""SELECT feature, day,
       CAST(COALESCE(first_value(n IGNORE NULLS) {_W_AFTER}, 0) AS BIGINT) AS n FROM g"""
SQL["fill_interpolate"] = with_(*_SPARSE,
                                "g2 AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY day) AS pos FROM g)",
                                f"""g3 AS (SELECT *,
  last_value(CAST(n AS DOUBLE) IGNORE NULLS) {_W_BEFORE} AS pv,
  last_value(CASE WHEN n IS NOT NULL THEN pos END IGNORE NULLS) {_W_BEFORE} AS pp,
  first_value(CAST(n AS DOUBLE) IGNORE NULLS) {_W_AFTER} AS nv,
  first_value(CASE WHEN n IS NOT NULL THEN pos END IGNORE NULLS) {_W_AFTER} AS np
  FROM g2)""") + """SELECT feature, day, COALESCE(CASE WHEN n IS NOT NULL THEN CAST(n AS DOUBLE)
  WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
  ELSE (nv - pv) / CAST(np - pp AS DOUBLE) * CAST(pos - pp AS DOUBLE) + pv END, 0.0) AS n FROM g3"""

# --- joins -----------------------------------------------------------------------------

JOIN_CTES = (*ALL_BASE, DIAG_STACK, _DCAT, _XCAT,
              "bd AS (SELECT min(day) AS lo, max(day) AS hi FROM dcat)",
              "bg AS (SELECT min(day) AS lo, max(day) AS hi FROM xcat)",
              "ball AS (SELECT least(bd.lo, bg.lo) AS lo, greatest(bd.hi, bg.hi) AS hi FROM bd, bg)",
              calendar("cal0", "ball"),
              "cal AS (SELECT day FROM cal0, bd, bg WHERE day BETWEEN bd.lo AND bd.hi OR day BETWEEN bg.lo AND bg.hi)",
              """gd AS (SELECT 'DEMAND_' || f.feature AS feature, cal.day,
    CASE WHEN cal.day BETWEEN bd.lo AND bd.hi THEN COALESCE(dcat.n, 0) END AS n
  FROM (SELECT DISTINCT feature FROM dcat) f CROSS JOIN cal CROSS JOIN bd
  LEFT JOIN dcat ON dcat.feature = f.feature AND dcat.day = cal.day)""",
              """gx AS (SELECT 'DIAGNOSIS_' || f.feature AS feature, cal.day,
    CASE WHEN cal.day BETWEEN bg.lo AND bg.hi THEN COALESCE(xcat.n, 0) END AS n
  FROM (SELECT DISTINCT feature FROM xcat) f CROSS JOIN cal CROSS JOIN bg
  LEFT JOIN xcat ON xcat.feature = f.feature AND xcat.day = cal.day)""",
              "gall AS (SELECT * FROM gd UNION ALL SELECT * FROM gx)",
              f"fl AS (SELECT feature, day, CAST(COALESCE(last_value(n IGNORE NULLS) {_W_BEFORE}, 0) AS BIGINT) AS n FROM gall)")

SQL["joined_daily"] = with_(*JOIN_CTES) + pivot("fl", names.joined_features())
SQL["final_recent"] = with_(*JOIN_CTES) + pivot(
    f"(SELECT * FROM fl WHERE day >= {_d(C.RECENT_FROM)} AND feature IN "
    f"({', '.join(repr(f) for f in C.RECENT_FEATURES)}))", C.RECENT_FEATURES)
SQL["monthly_trend"] = with_(*JOIN_CTES) + """SELECT CAST(date_trunc('month', day) AS DATE) AS month, feature,
       CAST(sum(n) AS BIGINT) AS n FROM fl GROUP BY 1, 2"""
SQL["historical_all"] = with_(*ALL_BASE, DIAG_STACK, demand_long(), diag_long()) + \
    f"SELECT day, {DEMAND_NAME} AS feature, n FROM dlong UNION ALL SELECT day, {DIAG_NAME} AS feature, n FROM xlong"


def _batch_wide(src: str, prefix: str, columns) -> str:
    """Per-batch pivots, unioned by name, latest batch per day, columns prefixed."""
    b1 = f"(SELECT day, '{prefix}' || feature AS feature, n FROM {src} WHERE day < {_d(C.BATCH1_END)})"
    b2 = f"(SELECT day, '{prefix}' || feature AS feature, n FROM {src} WHERE day >= {_d(C.BATCH2_START)})"
    return (f"SELECT * EXCLUDE (batch_id, rn) FROM (SELECT *, row_number() OVER (PARTITION BY timestamp "
            f"ORDER BY batch_id DESC) AS rn FROM ({pivot(b1, [prefix + c for c in columns if c != C.LATE_COLUMN], extra='1 AS batch_id, ')} UNION ALL BY NAME "
            f"{pivot(b2, [prefix + c for c in columns], extra='2 AS batch_id, ')}) u) w WHERE rn = 1")


_TOTAL_OR_CHAPTER = "variable IN ('TOTAL', 'ICD10_CHAPTER')"
_CH_CAT_TOTAL = f"chct AS (SELECT day, {DIAG_NAME} AS feature, n FROM ({scoped('xst', 'diagnosis', ('CAT',), _TOTAL_OR_CHAPTER, 'sum(n)')}) t)"
_MERGE_CTES = (*ALL_BASE, DIAG_STACK, _DCAT, _CH_CAT_TOTAL)
SQL["merge_finals"] = with_(*_MERGE_CTES) + f"""SELECT * FROM ({_batch_wide('dcat', '', names.demand_features('CAT'))}) a
FULL OUTER JOIN ({_batch_wide('chct', 'DIAG_', names.diagnosis_features('CAT', ['ICD10_CHAPTER']))}) b USING (timestamp)"""
SQL["merge_staging"] = with_(*_MERGE_CTES) + f"""SELECT * FROM ({_batch_wide('dcat', 'DEMAND_', names.demand_features('CAT'))}) a
FULL OUTER JOIN ({_batch_wide('chct', 'DIAGNOSIS_', names.diagnosis_features('CAT', ['ICD10_CHAPTER']))}) b USING (timestamp)"""

# --- staging, dedup, retention ------------------------------------------------------------

SQL["dedup_latest"] = with_(*DEMAND_BASE) + f"""SELECT * REPLACE (
  CASE WHEN day >= {_d(C.BATCH2_START)} THEN n * 10 + 1 ELSE n END AS n) FROM ({scoped("dst", "demand", ("CAT",))}) t"""

_BATCHED = f"""st AS (
  SELECT *, 1 AS batch_id FROM dx WHERE DATA_VISITA < {_d(C.BATCH1_END)}
  UNION ALL SELECT *, 2 AS batch_id FROM dx WHERE DATA_VISITA >= {_d(C.BATCH2_START)})"""
_LATEST = "lt AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY DATA_VISITA, ICD10_3, UP ORDER BY batch_id DESC) AS rn FROM st) t WHERE rn = 1)"
SQL["load_staging"] = with_(*DIAG_BASE, _BATCHED, _LATEST) + "SELECT * FROM lt"
SQL["staging_range"] = with_(*DIAG_BASE, _BATCHED, _LATEST) + \
    f"SELECT * FROM lt WHERE DATA_VISITA BETWEEN {_d(C.STAGING_RANGE[0])} AND {_d(C.STAGING_RANGE[1])}"
SQL["staging_to_final"] = with_(*DIAG_BASE, _BATCHED, _LATEST) + \
    f"SELECT * FROM lt WHERE DATA_VISITA BETWEEN {_d(C.FINAL_RANGE[0])} AND {_d(C.FINAL_RANGE[1])}"
SQL["staging_manifest"] = with_(*DIAG_BASE, _BATCHED) + """SELECT batch_id, min(DATA_VISITA) AS min_timestamp,
       max(DATA_VISITA) AS max_timestamp, count(*) AS num_rows,
       CASE batch_id WHEN 1 THEN TIMESTAMP '1999-01-01 06:00:00' ELSE TIMESTAMP '2001-11-05 06:00:00' END AS last_update
FROM st GROUP BY batch_id"""
SQL["retention_keep"] = with_(*DIAG_BASE, _BATCHED) + f"""SELECT batch_id, max(DATA_VISITA) AS max_timestamp,
       max(DATA_VISITA) >= {_d(C.AS_OF - dt.timedelta(days=C.RETENTION_DAYS))} AS keep FROM st GROUP BY batch_id"""
SQL["last_date_in_finals"] = with_(*ALL_BASE, DIAG_STACK) + f"""SELECT max(day) AS last_date FROM (
  SELECT day FROM dst UNION ALL SELECT day FROM xst) t
WHERE day BETWEEN DATE '1992-01-01' AND {_d(C.AS_OF + dt.timedelta(days=1))}"""
SQL["stored_bounds"] = with_(*DEMAND_BASE, _DCAT) + "SELECT min(day) AS min_date, max(day) AS max_date FROM dcat"
SQL["batch_reduce"] = with_(*DIAG_BASE) + """SELECT DATA_VISITA, RS, ICD10_CHAPTER, CAST(sum(n) AS BIGINT) AS n
FROM dx GROUP BY 1, 2, 3"""
SQL["narrow_types"] = with_(*DEMAND_BASE, _DCAT) + f"""SELECT column_name, CAST(min(v) AS DOUBLE) AS min_value,
       CAST(max(v) AS DOUBLE) AS max_value,
       CASE WHEN min(v) >= -128 AND max(v) <= 127 THEN 'tinyint'
            WHEN min(v) >= -32768 AND max(v) <= 32767 THEN 'smallint'
            WHEN min(v) >= -2147483648 AND max(v) <= 2147483647 THEN 'int' ELSE 'bigint' END AS narrow_type
FROM ({cells('dcat', names.demand_features('CAT'), 'column_name', 'v')}) u
GROUP BY column_name"""

# --- incremental -------------------------------------------------------------------------

SQL["incremental_two_batches"] = SQL["demand_all_scopes"]
SQL["incremental_interrupted"] = SQL["demand_all_scopes"]
SQL["incremental_add"] = SQL["demand_all_scopes"]
SQL["incremental_diagnosis_two_batches"] = with_(*DIAG_BASE, DIAG_STACK) + scoped(
    "xst", "diagnosis", ("CAT", "RS", "UP"), "TRUE", "sum(n)")

# --- quality -------------------------------------------------------------------------------

SQL["unknown_codes_report"] = with_(DIAG_PARSE, f"""chap AS (SELECT * FROM (VALUES {_values([(i, n, lo, hi) for i, (n, lo, hi) in enumerate(CHAPTER_RANGES)])}) t(priority, name, lo, hi))""",
                                    """valid AS (SELECT DISTINCT DIAG_CODE, ICD10_CODE, substr(ICD10_CODE, 1, 3) AS ICD10_3
  FROM dnorm WHERE DATA_VISITA IS NOT NULL AND UP IS NOT NULL AND ICD10_CODE IS NOT NULL)""") + f"""SELECT DIAG_CODE, ICD10_CODE, ICD10_3 FROM valid v
WHERE NOT EXISTS (SELECT 1 FROM chap r WHERE {ordinal('v.ICD10_3')} BETWEEN {ordinal('r.lo')} AND {ordinal('r.hi')})
ORDER BY DIAG_CODE LIMIT 100"""
SQL["unknown_units"] = with_(LOOKUP, RAW_ROWS) + """SELECT UP, count(*) AS n FROM rr
WHERE UP IS NOT NULL AND UP NOT IN (SELECT UP FROM lk) GROUP BY UP"""

# --- streaming -------------------------------------------------------------------------------

SQL["stream_daily_counts"] = "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"

SQL["stream_late_rows"] = SQL["stream_daily_counts"]
SQL["stream_compacted"] = SQL["stream_daily_counts"]

# --- increments under wrong and lost rows ------------------------------------------------------

SQL["incremental_future_row"] = SQL["demand_all_scopes"]
SQL["incremental_deleted_day"] = with_(*DEMAND_BASE) + scoped(
    "dst", "demand", where=f"(day < {_d(C.DELETED[0])} OR day >= {_d(C.DELETED[1])})")

# --- stores and checks ---------------------------------------------------------------------------

_FEW = [c for c in names.demand_features("CAT") if "TOTAL" in c or "SERVEI" in c]
_FEW_CTE = "few AS (SELECT * FROM dcat WHERE feature LIKE '%TOTAL%' OR feature LIKE '%SERVEI%')"
_FEW_BASE = with_(*DEMAND_BASE, _DCAT, _FEW_CTE)
SQL["matrix_csv_round_trip"] = _FEW_BASE + pivot("few", _FEW)
SQL["matrix_dual_write"] = _FEW_BASE + f"""SELECT c.*, k.kind FROM ({cells("few", _FEW)}) c
CROSS JOIN (VALUES ('parquet'), ('csv')) k(kind)"""
SQL["long_partitioned_store"] = with_(*DEMAND_BASE) + f"""SELECT day, group_value, variable, value, n
FROM ({scoped("dst", "demand", ("RS",))}) t"""
SQL["data_ids"] = with_(*DIAG_BASE) + "SELECT CAST(DATA_VISITA AS VARCHAR) || '|' || ICD10_3 || '|' || UP AS data_id, n FROM dx"
SQL["narrow_casts"] = _FEW_BASE + cells("few", _FEW)
SQL["state_watermark"] = with_(LOOKUP, VISITS_CLEAN) + "SELECT max(day) AS last_loaded_date FROM vc"
SQL["recorded_watermark"] = with_(*DIAG_BASE) + "SELECT max(DATA_VISITA) AS recorded, max(DATA_VISITA) AS stored FROM dx"
SQL["compact_staging_batches"] = with_(*DIAG_BASE, _BATCHED, _LATEST) + "SELECT * EXCLUDE (batch_id) FROM lt"
SQL["aligned_matrices"] = _FEW_BASE + pivot(
    f"(SELECT day, CASE WHEN day < {_d(C.BATCH1_END)} AND feature = 'demanda__TOTAL_CAT' THEN NULL "
    f"WHEN day >= {_d(C.BATCH1_END)} AND feature = 'demanda__SERVEI_CODI__5-LOW' THEN NULL ELSE feature END AS feature, n FROM few)", _FEW)
SQL["range_totals"] = with_(*JOIN_CTES) + f"""SELECT feature, CAST(sum(n) AS BIGINT) AS n FROM fl
WHERE day BETWEEN {_d(C.FINAL_RANGE[0])} AND {_d(C.FINAL_RANGE[1])} GROUP BY feature"""
SQL["diagnosis_code_blocks"] = with_(*DIAG_BASE) + """SELECT DATA_VISITA AS timestamp, 'DIAG_CODE_' || ICD10_3 AS feature,
       CAST(sum(n) AS BIGINT) AS n FROM dx GROUP BY 1, 2"""

# --- dense blocks of columns ---------------------------------------------------------------------

SQL["raw_code_blocks"] = with_(RAW_ROWS) + """SELECT day AS timestamp, 'DIAG_CODE_' || DIAG_CODE AS feature, count(*) AS n
FROM rr GROUP BY 1, 2"""


def column_digests(src: str, first: str, days: str) -> str:
    """Digest of each column of dense matrices whose cells are ``src(matrix, day, feature, n)``."""
    return (f"SELECT matrix, feature, ({days}) AS n_days, count(*) AS n_nonzero, CAST(sum(n) AS BIGINT) AS total, "
            f"CAST(sum(n * (date_diff('day', ({first}), day) + 1)) AS BIGINT) AS weighted FROM {src} GROUP BY 1, 2")


def _up(src: str, name: str, default: str) -> str:
    return (f"up AS (SELECT COALESCE(CASE WHEN lk.RS = 'SENSEESPECIFICAR_SE' THEN '{default}' ELSE lk.RS END, '{default}') AS matrix, "
            f"s.day, {name} AS feature, s.n FROM {src} s LEFT JOIN lk ON s.group_value = lk.UP)")


_SPAN = "SELECT date_diff('day', min(day), max(day)) + 1 FROM up"
_DEFAULT = "RS:SENSEESPECIFICAR_SE"
SQL["up_blocks_demand"] = with_(*DEMAND_BASE, demand_long(("UP",)), _up("dlong", DEMAND_NAME, _DEFAULT)) + \
    column_digests("up", "SELECT min(day) FROM up", _SPAN)
SQL["up_blocks_diagnosis"] = with_(*DIAG_BASE, DIAG_STACK, diag_long(("UP",)), _up("xlong", DIAG_NAME, _DEFAULT)) + \
    column_digests("up", "SELECT min(day) FROM up", _SPAN)

_HISTORY = f"""hist AS (
  SELECT 'demand_' || lower(scope) AS matrix, day, {DEMAND_NAME} AS feature, n FROM dlong
  UNION ALL SELECT 'diagnosis_' || lower(scope), day, {DIAG_NAME}, n FROM xlong)"""
_SPANS = """spans AS (SELECT DISTINCT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT matrix, min(day) AS lo, max(day) AS hi FROM hist GROUP BY matrix) b)"""
SQL["historical_blocks"] = with_(*ALL_BASE, DIAG_STACK, demand_long(), diag_long(), _HISTORY, _SPANS) + \
    column_digests("hist", "SELECT min(day) FROM spans", "SELECT count(*) FROM spans")

# --- months redone with a carried fill state -------------------------------------------------------

SQL["filled_months_redone"] = SQL["fill_forward"]

# --- final builds and checks as write-then-read jobs -------------------------------------------------

SQL["required_columns"] = with_() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n FROM visits" for c in VISIT_COLUMNS)
SQL["staging_skip_unreadable"] = with_(*DIAG_BASE, _BATCHED) + "SELECT * FROM st"
SQL["diagnosis_final_build"] = with_(*DIAG_BASE, DIAG_STACK, diag_long()) + \
    f"SELECT day AS timestamp, {DIAG_NAME} AS feature, n, scope FROM xlong"
SQL["historical_file"] = SQL["historical_all"]
