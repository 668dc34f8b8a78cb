"""Independent SQL oracle (DuckDB dialect) for every registered query.

The binding of the test tables and each report are written again as plain
SQL, by a different route than the Spark code (``FILTER`` clauses and
``UNION ALL`` for crosstabs and totals, window functions for top-k and
keep-first), so a shared mistake is unlikely.  Tables ``region nation
customer part orders lineitem events`` are views provided by the caller.
"""

from __future__ import annotations

from quantis.sources.binding import CATEGORY_NAMES, DIVERGENT_COUNTY, DIVERGENT_REGION, ROOT_ID

IT = "item_description_name_form_strength"
QTY = "quantity_required_for_period_specified_above"
VAL = "value_of_quantities_required_for_12_months"
BUF = "value_of_quantities_required_including_buffer_kes"
PRO = "value_of_quantities_to_be_procured_kes"
M = "DECIMAL(18,4)"

# The cleaned tab labels of CATEGORY_NAMES 1-14, worked out by
# hand from the cleaner's rules (first '.', first digit, first 0, 1, 2).
CLEAN_LABELS = (
    "Nutrition", "Pharmaceuticals", "Non-Pharmaceuticals", "Laboratory", "Renal", "Radiology", "Dental",
    "Orthopaedics", "Ophthalmology", "Physiotherapy", "Theatre", "Maternity", "3Oncology", "4Immunisation",
)
KEPH = tuple(f"KEPH Level {i}" for i in range(2, 7))


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def title(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def clean(x: str) -> str:
    s = f"regexp_replace({x}, '\\.', '')"
    for pat in ("[0-9]", "0", "1", "2"):
        s = f"regexp_replace({s}, '{pat}', '')"
    return s


def pct(ratio: str) -> str:
    return f"regexp_replace(CAST(round_even(({ratio}) * 100, 2) AS VARCHAR), '\\.0$', '') || '%'"


def mul(a: str, b: str) -> str:
    return f"CAST(CAST({a} AS {M}) * CAST({b} AS {M}) AS {M})"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def nse(a: str, b: str) -> str:
    return f"{a} IS NOT DISTINCT FROM {b}"


CATS = "[" + ", ".join(f"'{c}'" for c in CATEGORY_NAMES) + "]"
TAB = f"CAST(p_size % 14 + 1 AS VARCHAR) || '.' || ({CATS})[p_size % 14 + 1]"

FC_COLS = [
    "county", "sub_county", "facility_type", "facility_name", "sub_category", "keph_level", "tab", "ven",
    "funding", IT, "pack_size", "price_kes", QTY, VAL, BUF, PRO, "contains_lab",
]
TN_COLS = [
    "county", "sub_county", "facility_type", "facility_name", "sub_category", "keph_level", "tab", "ven",
    "funding", IT, "pack_size.x", "price_kes", "new_price_kes", QTY, "quantity_required_buffer_packs",
    "quantity_required_to_procure_packs", VAL, BUF, PRO, "contains_lab", "source_row",
]
MONEY_COLS = {VAL, BUF, PRO}


def out_cols(cols, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(f"{dbl(p + q(c))} AS {q(c)}" if c in MONEY_COLS else f"{p}{q(c)}" for c in cols)


BASE = f"""
fac AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_name, n.n_regionkey, r.r_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
fact AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_returnflag,
         l.l_linestatus, f.*, p.p_name, p.p_type, p.p_size, p.p_retailprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN fac f ON o.o_custkey = f.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
),
forecasts AS (
  SELECT {title('r_name')} AS county, n_name AS sub_county, c_mktsegment AS facility_type,
    c_name AS facility_name, p_type AS sub_category,
    'KEPH Level ' || CAST(c_custkey % 5 + 2 AS VARCHAR) AS keph_level, {TAB} AS tab,
    CASE WHEN l_returnflag = 'R' THEN 'V' WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'e'
      WHEN l_returnflag = 'A' THEN 'E' END AS ven,
    CASE WHEN l_linestatus = 'F' THEN 'County' ELSE 'Partner' END AS funding,
    p_name AS {IT}, CAST(p_size AS VARCHAR) AS pack_size, p_retailprice AS price_kes, l_quantity AS {QTY},
    {mul('l_quantity', 'p_retailprice')} AS {VAL},
    CAST(l_extendedprice AS {M}) AS {BUF},
    CAST(CAST(l_extendedprice AS {M}) * (1 - CAST(l_discount AS {M})) AS {M}) AS {PRO},
    CASE WHEN p_size % 14 + 1 = 4 THEN 'Yes' ELSE 'No' END AS contains_lab
  FROM fact WHERE r_name <> '{DIVERGENT_REGION}'
),
forecasts_tn AS (
  SELECT r_name AS county, n_name AS sub_county, c_mktsegment AS facility_type,
    c_name AS facility_name, p_type AS sub_category,
    'KEPH Level ' || CAST(c_custkey % 5 + 2 AS VARCHAR) AS keph_level, {TAB} AS tab,
    CASE l_returnflag WHEN 'R' THEN 'V' WHEN 'A' THEN 'e' ELSE 'N' END AS ven,
    CASE WHEN l_linestatus = 'F' THEN 'County' ELSE 'Partner' END AS funding,
    p_name AS {IT}, CAST(p_size AS VARCHAR) AS "pack_size.x", p_retailprice AS price_kes,
    p_retailprice + CAST(10 AS DOUBLE) AS new_price_kes, l_quantity AS {QTY},
    l_quantity + CAST(2 AS DOUBLE) AS quantity_required_buffer_packs,
    l_quantity + CAST(1 AS DOUBLE) AS quantity_required_to_procure_packs,
    CAST(l_extendedprice AS {M}) AS {VAL}, CAST(l_extendedprice AS {M}) AS {BUF},
    CAST(l_extendedprice AS {M}) AS {PRO},
    CASE WHEN p_size % 14 + 1 = 4 THEN 'Yes' ELSE 'No' END AS contains_lab,
    l_orderkey * 8 + l_linenumber AS source_row
  FROM fact WHERE r_name = '{DIVERGENT_REGION}'
),
pk AS (
  SELECT p_name AS item, {TAB} AS tab, min(p_partkey) AS k, min(p_brand) AS brand, min(p_type) AS ptype
  FROM part GROUP BY 1, 2
),
classes AS (
  SELECT CASE WHEN k % 7 = 0 THEN item || '.' ELSE item END AS {IT}, tab,
    CASE WHEN k % 3 = 0 THEN 'Product' WHEN k % 3 = 1 THEN 'Equipment' WHEN k % 9 = 2 THEN 'Consumable' END
      AS product_or_equipment,
    CASE WHEN k % 11 <> 0 THEN brand END AS product_classification,
    CASE WHEN k % 4 = 0 THEN 'Yes' WHEN k % 4 = 1 THEN 'No' WHEN k % 8 = 2 THEN 'Unknown' END AS rmnch_product,
    ptype AS moh_647_name
  FROM pk
),
new_cat AS (
  SELECT CASE WHEN k % 4 = 0 THEN item || '.' ELSE item END AS item_name, tab AS product_category,
    CASE WHEN k % 3 = 0 THEN 'V' WHEN k % 3 = 1 THEN 'E' WHEN k % 6 = 2 THEN 'X' ELSE 'N' END AS ven,
    CASE WHEN k % 5 = 0 THEN 'Equipment' ELSE 'Product' END AS product_or_equipment
  FROM pk
),
nc AS (SELECT item_name, product_category, ven AS new_ven, TRUE AS hit FROM new_cat),
rmnch AS (SELECT DISTINCT p_name AS product FROM part WHERE p_name LIKE 'small %' OR p_name LIKE 'red %'),
org_units AS (
  SELECT '{ROOT_ID}' AS id, 'Kenya' AS name, CAST(NULL AS VARCHAR) AS parent_id
  UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR), {title('r_name')} || ' County', '{ROOT_ID}' FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), n_name || ' Sub County', 'R' || CAST(n_regionkey AS VARCHAR)
    FROM nation
  UNION ALL SELECT DISTINCT 'W' || CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment,
    {title('c_mktsegment')} || ' Ward', 'N' || CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'F' || CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 13 = 0 THEN c_name || '.' ELSE c_name END,
    'W' || CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment FROM customer
),
counties AS (
  SELECT id AS county_id, trim(regexp_replace(name, ' County| Sub County', '')) AS county
  FROM org_units WHERE parent_id = '{ROOT_ID}'
),
subs AS (SELECT o.id AS sub_id, o.name AS sub_name, c.county FROM org_units o JOIN counties c ON o.parent_id = c.county_id),
wards AS (SELECT o.id AS ward_id, o.name AS ward_name, s.sub_name, s.county FROM org_units o JOIN subs s ON o.parent_id = s.sub_id),
hierarchy AS (
  SELECT DISTINCT w.county, replace(w.sub_name, ' Sub County', '') AS sub_county,
    replace(w.ward_name, ' Ward', '') AS ward, o.name AS facility_name
  FROM org_units o JOIN wards w ON o.parent_id = w.ward_id
),
overrides AS (
  SELECT facility_name, min(ward) AS override_ward FROM
    (SELECT c_name AS facility_name, 'Override' AS ward FROM customer WHERE c_custkey % 20 = 0)
  GROUP BY facility_name
),
analytics AS (
  SELECT event_type AS data, CAST(year(ts) AS VARCHAR) AS period,
    'F' || CAST(user_id AS VARCHAR) AS organisation_unit,
    'O' || CAST(event_id % 3 AS VARCHAR) AS facility_ownership,
    'K' || CAST(event_id % 5 AS VARCHAR) AS keph_level,
    CAST(value AS DOUBLE) AS value, CAST(value AS DOUBLE) AS numerator, CAST(1 AS DOUBLE) AS denominator,
    CAST(1 AS DOUBLE) AS factor, CAST(1 AS DOUBLE) AS multiplier, CAST(1 AS DOUBLE) AS divisor
  FROM events
),
organisation_units AS (
  SELECT 'F' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 13 = 0 THEN '.' ELSE '' END AS facility_id,
    c_name AS facility_name,
    {title('c_mktsegment')} AS ward_name, n_name AS sub_county_name, {title('r_name')} AS county_name,
    CAST(c_custkey + 100000 AS VARCHAR) AS mfl_code
  FROM fac
),
keph_levels AS (
  SELECT * FROM (VALUES ('K0', 'KEPH Level 2'), ('K1', 'KEPH Level 3'), ('K2', 'KEPH Level 4'),
    ('K3', 'KEPH Level 5'), ('K04', 'KEPH Level 6')) t(keph_level_id, keph_level_name)
),
ownerships AS (
  SELECT * FROM (VALUES ('O0', 'Ministry of Health (Government)', 'Ministry of Health'),
    ('O1', 'Private Practice (General)', 'Private Practice'), ('O2', 'Faith Based Organisation', 'Faith Based'))
    t(facility_ownership_id, facility_ownership, facility_ownership_short)
)"""


def with_(*ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH" + BASE + extra + "\n"


def crosstab(src: str, by: list[str], rows: list[str], key: str, vals, fill=True, row_total=False,
             col_total=False, flag: str | None = None) -> str:
    """SQL crosstab of ``v`` over ``src`` (columns by, rows, key, v); values
    outside ``vals`` are the column ``Other``, and ``Total`` is the plain sum."""
    g = ", ".join(by + rows)
    cells = []
    for i, v in enumerate(vals):
        s = f"coalesce(sum(v) FILTER (WHERE {key} = '{v}'), 0)"
        c = f"count(*) FILTER (WHERE {key} = '{v}')"
        cells.append(f"{s} AS s{i}, {c} AS c{i}")
    inlist = ", ".join(f"'{v}'" for v in vals)
    other = f"FILTER (WHERE {key} NOT IN ({inlist}))"
    cells.append(f"coalesce(sum(v) {other}, 0) AS s{len(vals)}, count(*) {other} AS c{len(vals)}")
    vals = [*vals, "Other"]
    tot = "coalesce(sum(v), 0) AS tot"
    body = f"SELECT {g}, {', '.join(cells)}, {tot} FROM {src} GROUP BY {g}"

    def proj(total: bool) -> str:
        ks = ", ".join(by)
        if total:
            rk = ", ".join(("'Total'" if i == 0 else "'-'") + f" AS {r}" for i, r in enumerate(rows))
            cs = [f"{dbl(f'sum(s{i})')} AS {q(v)}" for i, v in enumerate(vals)]
            if col_total:
                cs.append(f"{dbl('sum(tot)')} AS \"Total\"")
            if flag:
                cs.append(f"TRUE AS {flag}")
            return f"SELECT {ks + ', ' if ks else ''}{rk}, {', '.join(cs)} FROM cells GROUP BY {ks or '()'}"
        rk = ", ".join(rows)
        cs = []
        for i, v in enumerate(vals):
            cs.append(f"{dbl(f's{i}')} AS {q(v)}" if fill else f"CASE WHEN c{i} > 0 THEN {dbl(f's{i}')} END AS {q(v)}")
        if col_total:
            cs.append(f"{dbl('tot')} AS \"Total\"")
        if flag:
            cs.append(f"FALSE AS {flag}")
        return f"SELECT {ks + ', ' if ks else ''}{rk}, {', '.join(cs)} FROM cells"

    sql = f"(WITH cells AS ({body}) {proj(False)}"
    if row_total:
        sql += f" UNION ALL {proj(True)}"
    return sql + ")"


def poe_defaults(poe: str, tab: str) -> str:
    return (
        f"CASE WHEN {poe} IS NULL AND {tab} = '10.Physiotherapy' THEN 'Equipment' "
        f"WHEN {poe} IS NULL AND {tab} IN ('4.Laboratory', '7.Dental', '2.Pharmaceuticals', '6.Radiology') "
        f"THEN 'Product' ELSE {poe} END"
    )


def join_cls(f: str = "f", c: str = "c") -> str:
    return f"{nse(f'{f}.{IT}', f'{c}.{IT}')} AND {nse(f'{f}.tab', f'{c}.tab')}"


def join_nc(f: str = "f", n: str = "n") -> str:
    return f"{nse(f'{f}.{IT}', f'{n}.item_name')} AND {nse(f'{f}.tab', f'{n}.product_category')} AND {f}.ven IS NULL"


RESOLVED_LEFT = f"""resolved_left AS (
  SELECT {', '.join('CASE WHEN n.hit THEN n.new_ven ELSE f.ven END AS ven' if c == 'ven' else 'f.' + q(c) for c in FC_COLS)}
  FROM forecasts f LEFT JOIN nc n ON {join_nc()}
)"""
RESOLVED_INNER = f"""resolved_inner AS (
  SELECT {', '.join('CASE WHEN n.hit THEN n.new_ven ELSE f.ven END AS ven' if c == 'ven' else 'f.' + q(c) for c in FC_COLS)}
  FROM forecasts f LEFT JOIN nc n ON {join_nc()} WHERE f.ven IS NOT NULL OR n.hit
)"""
ASSIGNED = f"""assigned AS (
  SELECT f.*, CASE WHEN o.facility_name IS NOT NULL THEN o.override_ward ELSE h.ward END AS ward
  FROM forecasts f
  LEFT JOIN hierarchy h ON {nse('f.county', 'h.county')} AND {nse('f.sub_county', 'h.sub_county')}
    AND {nse('f.facility_name', 'h.facility_name')}
  LEFT JOIN overrides o ON {nse('f.facility_name', 'o.facility_name')}
)"""
ASSIGNED_TN = f"""assigned_tn AS (
  SELECT f.*, CASE WHEN o.facility_name IS NOT NULL THEN o.override_ward ELSE h.ward END AS ward
  FROM (SELECT * REPLACE ({title('county')} AS county) FROM forecasts_tn) f
  LEFT JOIN hierarchy h ON {nse('f.county', 'h.county')} AND {nse('f.sub_county', 'h.sub_county')}
    AND {nse('f.facility_name', 'h.facility_name')}
  LEFT JOIN overrides o ON {nse('f.facility_name', 'o.facility_name')}
)"""
UNIFIED = f"""u AS (
  SELECT '{DIVERGENT_COUNTY}' AS county, sub_county, facility_type, facility_name, sub_category, keph_level, tab,
    CASE WHEN ven IN ('V', 'E', 'N') THEN ven END AS ven, funding, {IT}, "pack_size.x" AS pack_size,
    new_price_kes AS price_kes, {QTY}, {mul(QTY, 'new_price_kes')} AS {VAL}, {BUF}, {PRO}, contains_lab
  FROM forecasts_tn
  UNION ALL
  SELECT county, sub_county, facility_type, facility_name, sub_category, keph_level, tab, ven, funding, {IT},
    pack_size, price_kes, {QTY}, {mul(QTY, 'price_kes')} AS {VAL}, {BUF}, {PRO}, contains_lab
  FROM forecasts
),
unified AS (
  SELECT u.*, c.product_or_equipment, c.product_classification, c.rmnch_product, c.moh_647_name
  FROM u LEFT JOIN classes c ON {join_cls('u', 'c')}
)"""
RMNCH_LONG = f"""rl AS (
  SELECT f.county, {clean('f.tab')} AS tab, coalesce(c.rmnch_product, 'No') AS r, sum(f.{VAL}) AS metric
  FROM forecasts f LEFT JOIN classes c ON {join_cls()} WHERE f.funding = 'County' GROUP BY 1, 2, 3
)"""
PRODUCTS_TN = f"""ptn AS (
  SELECT county, {clean('tab')} AS tab, {IT}, {dbl('v')} AS {VAL} FROM (
    SELECT county, tab, {IT}, coalesce(sum({mul(QTY, 'new_price_kes')}), 0) AS v
    FROM forecasts_tn WHERE funding = 'County' GROUP BY county, tab, {IT})
)"""
WORK_EXTRACT = """wx AS (
  SELECT * FROM analytics WHERE period = '2024' AND data IN ('signup', 'view', 'click', 'purchase')
    AND facility_ownership IN ('O0', 'O1', 'O2') AND keph_level IN ('K0', 'K1', 'K2', 'K3', 'K4')
)"""
WORK_AGG = f"""wa AS (
  SELECT organisation_unit, facility_ownership, keph_level,
    {dbl('coalesce(sum(CAST(value AS DECIMAL(28,10))), 0)')} AS value
  FROM wx GROUP BY 1, 2, 3
)"""
WORK_ENRICH = """we AS (
  SELECT k.keph_level_name AS keph_level, ou.county_name AS county, ou.sub_county_name AS sub_county,
    ou.ward_name AS ward, ou.facility_name, a.organisation_unit AS facility_id,
    ou.sub_county_name AS sub_county_2, ou.mfl_code, o.facility_ownership_short AS facility_ownership,
    a.value AS total_workload
  FROM wa a LEFT JOIN organisation_units ou ON a.organisation_unit = ou.facility_id
  JOIN keph_levels k ON a.keph_level = k.keph_level_id
  JOIN ownerships o ON a.facility_ownership = o.facility_ownership_id
  WHERE o.facility_ownership_short = 'Ministry of Health'
)"""
ITEM_FIRST = f"""ifirst AS (
  SELECT {IT}, tab, ven FROM (
    SELECT *, row_number() OVER (PARTITION BY {IT} ORDER BY tab ASC NULLS LAST, ven ASC NULLS FIRST) AS rn
    FROM (SELECT DISTINCT {IT}, tab, ven FROM forecasts)) WHERE rn = 1
)"""
CLASS_COLS = "c.tab AS class_tab, c.product_or_equipment, c.product_classification, c.rmnch_product, c.moh_647_name"


def _top(src: str, part: str, order: str, n: int, fn: str = "row_number()") -> str:
    return f"SELECT * EXCLUDE (rk) FROM (SELECT *, {fn} OVER (PARTITION BY {part} ORDER BY {order}) AS rk FROM {src}) WHERE rk <= {n}"


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["county_forecasts"] = with_() + f"SELECT {out_cols(FC_COLS)} FROM forecasts WHERE lower(county) = 'asia'"
    s["all_counties"] = with_(UNIFIED) + "SELECT " + out_cols(
        FC_COLS + ["product_or_equipment", "product_classification", "rmnch_product", "moh_647_name"]
    ) + " FROM unified"
    s["county_summary"] = with_(UNIFIED) + (
        f"SELECT county, {dbl(f'coalesce(sum({VAL}), 0)')} AS {VAL} FROM unified WHERE funding = 'County' GROUP BY county"
    )
    s["county_forecasts_discovered"] = s["county_forecasts"]
    s["county_summary_two_sources"] = s["county_summary"]
    s["all_counties_two_sources"] = s["all_counties"]
    s["county_split_summary"] = with_() + (
        f"SELECT county, sub_county, count(*) AS n_rows, {dbl(f'sum({VAL})')} AS {VAL} FROM forecasts GROUP BY county, sub_county"
    )
    s["distinct_counties"] = with_() + f"SELECT DISTINCT {title('r_name')} AS county FROM fac"

    poe = f"""b AS (
  SELECT f.county, {clean('f.tab')} AS tab, coalesce({poe_defaults('c.product_or_equipment', 'f.tab')}, 'NA') AS k,
    f.{VAL} AS v
  FROM forecasts f LEFT JOIN classes c ON {join_cls()} WHERE f.funding = 'County'
)"""
    s["by_product_or_equipment"] = with_(poe) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["tab"], "k", ["Product", "Equipment", "NA"], row_total=True, col_total=True
    )
    poe_tn = f"""b AS (
  SELECT f.county, {clean('f.tab')} AS tab, coalesce(c.product_or_equipment, 'Product') AS k,
    {mul('f.' + QTY, 'f.new_price_kes')} AS v
  FROM forecasts_tn f LEFT JOIN classes c ON {join_cls()} WHERE f.funding = 'County'
)"""
    s["by_product_or_equipment_tn"] = with_(poe_tn) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["tab"], "k", ["Product", "Equipment"]
    )
    tn_m = {"v": VAL, "b": BUF, "p": PRO}
    poe_m = f"""f AS (
  SELECT *, {mul(QTY, 'new_price_kes')} AS m_v, {mul('quantity_required_buffer_packs', 'new_price_kes')} AS m_b,
    {mul('quantity_required_to_procure_packs', 'new_price_kes')} AS m_p
  FROM forecasts_tn WHERE funding = 'County'
),
b AS (""" + " UNION ALL ".join(
        f"SELECT f.county, {clean('f.tab')} AS tab, '{name}' AS measure, coalesce(c.product_or_equipment, 'Product') AS k, "
        f"f.m_{m} AS v FROM f LEFT JOIN classes c ON {join_cls()}" for m, name in tn_m.items()
    ) + ")"
    s["by_product_or_equipment_tn_measures"] = with_(poe_m) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["tab", "measure"], "k", ["Product", "Equipment"]
    )
    s["resolve_ven_left"] = with_(RESOLVED_LEFT) + f"SELECT {out_cols(FC_COLS)} FROM resolved_left"
    s["resolve_ven_inner"] = with_(RESOLVED_INNER) + f"SELECT {out_cols(FC_COLS)} FROM resolved_inner"
    tn_cols = ", ".join(
        "CASE WHEN ven IN ('V', 'E', 'N') THEN ven END AS ven" if c == "ven"
        else (f"{dbl(q(c))} AS {q(c)}" if c in MONEY_COLS else q(c))
        for c in TN_COLS
    )
    s["sanitise_ven"] = with_() + f"SELECT {tn_cols} FROM forecasts_tn"
    ven_b = f"""b AS (
  SELECT county, {clean('tab')} AS tab, coalesce(ven, 'NA') AS k, {VAL} AS v FROM resolved_left WHERE funding = 'County'
)"""
    s["by_ven"] = with_(RESOLVED_LEFT, ven_b) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["tab"], "k", ["V", "E", "N", "NA"], row_total=True, col_total=True
    )
    ven_long = ven_b + """,
cells AS (SELECT county, tab, k, coalesce(sum(v), 0) AS v FROM b GROUP BY county, tab, k),
rows_ AS (SELECT * FROM cells UNION ALL SELECT county, 'Total', k, sum(v) FROM cells GROUP BY county, k)"""
    s["by_ven_map"] = with_(RESOLVED_LEFT, ven_long) + (
        f"SELECT county, tab, k AS ven, {dbl('v')} AS value, {dbl('sum(v) OVER (PARTITION BY county, tab)')} AS \"Total\" FROM rows_"
    )
    ven_bi = f"""b AS (
  SELECT county, {clean('tab')} AS tab, coalesce(ven, 'NA') AS k, {mul(QTY, 'price_kes')} AS v
  FROM resolved_inner WHERE funding = 'County'
)"""
    s["by_ven_inner_recomputed"] = with_(RESOLVED_INNER, ven_bi) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["tab"], "k", ["V", "E", "N", "NA"], row_total=True, col_total=True
    )
    ven_tn = f"""stn AS (SELECT * REPLACE (CASE WHEN ven IN ('V', 'E', 'N') THEN ven END AS ven) FROM forecasts_tn),
rtn AS (
  SELECT f.county, f.tab, f.funding, CASE WHEN n.hit THEN n.new_ven ELSE f.ven END AS ven,
    {mul('f.' + QTY, 'f.new_price_kes')} AS v
  FROM stn f LEFT JOIN nc n ON {join_nc()}
),
b AS (SELECT county, {clean('tab')} AS tab, ven AS k, v FROM rtn WHERE funding = 'County' AND ven IS NOT NULL)"""
    s["by_ven_tn"] = with_(ven_tn) + "SELECT * FROM " + crosstab("b", ["county"], ["tab"], "k", ["V", "E", "N"])

    def ven_totals(src: str) -> str:
        return f"""(WITH l AS (SELECT county, ven, sum({VAL}) AS v FROM {src} WHERE funding = 'County' GROUP BY 1, 2)
SELECT county, ven, {dbl('v')} AS {VAL}, {dbl('v')} AS "Total" FROM l
UNION ALL SELECT county, 'Total', {dbl('sum(v)')}, {dbl('sum(v)')} FROM l GROUP BY county)"""

    s["ven_totals"] = with_() + "SELECT * FROM " + ven_totals("forecasts")
    s["ven_totals_resolved"] = with_(RESOLVED_INNER) + "SELECT * FROM " + ven_totals("resolved_inner")

    share = f"""sh AS (
  SELECT county, tab, r AS k,
    CAST(round_even({dbl('metric')} / {dbl('sum(metric) OVER (PARTITION BY county, tab)')}, 2) AS DECIMAL(12,2)) AS v
  FROM rl
),
w AS {crosstab('sh', ['county'], ['tab'], 'k', ['Yes', 'No'], row_total=True, col_total=True, flag='is_t')}"""
    s["rmnch_share"] = with_(RMNCH_LONG, share) + (
        "SELECT county, tab, \"Yes\", \"No\", \"Other\", CASE WHEN is_t THEN '-' ELSE "
        + pct('"Yes" / ("Yes" + "No")')
        + " END AS \"% of RMNCH\", \"Total\" FROM w"
    )
    vp = f"""cells AS (
  SELECT county, tab, coalesce(sum(metric) FILTER (WHERE r = 'Yes'), 0) AS y,
    coalesce(sum(metric) FILTER (WHERE r = 'No'), 0) AS n,
    coalesce(sum(metric) FILTER (WHERE r NOT IN ('Yes', 'No')), 0) AS o, coalesce(sum(metric), 0) AS a
  FROM rl GROUP BY county, tab
),
g AS (SELECT county, sum(a) AS grand FROM cells GROUP BY county)"""
    s["rmnch_value_pct"] = with_(RMNCH_LONG, vp) + (
        f"SELECT c.county, c.tab, {dbl('y')} AS \"RMNCH_Yes\", {dbl('n')} AS \"RMNCH_No\", {dbl('o')} AS \"RMNCH_Other\", {dbl('a')} AS \"Total\", "
        f"{pct(dbl('y') + ' / (' + dbl('y') + ' + ' + dbl('n') + ')')} AS \"% of RMNCH_Yes\", "
        f"{pct(dbl('y') + ' / ' + dbl('g.grand'))} AS \"% of RMNCH_Yes_total\" "
        f"FROM cells c JOIN g ON c.county = g.county "
        f"UNION ALL SELECT county, 'Total', {dbl('sum(y)')}, {dbl('sum(n)')}, {dbl('sum(o)')}, {dbl('sum(a)')}, '-', '-' "
        f"FROM cells GROUP BY county"
    )
    ys = "coalesce(sum(metric) FILTER (WHERE r = 'Yes'), 0)"
    ns = "coalesce(sum(metric) FILTER (WHERE r = 'No'), 0)"
    os = "coalesce(sum(metric) FILTER (WHERE r NOT IN ('Yes', 'No')), 0)"
    s["rmnch_summary"] = with_(RMNCH_LONG) + (
        f"SELECT county, {dbl(ys)} AS metric_yes, {dbl(ns)} AS metric_no, {dbl(os)} AS metric_other, "
        f"{dbl('coalesce(sum(metric), 0)')} AS total "
        "FROM rl GROUP BY county"
    )

    s["resolve_county_id"] = with_() + "SELECT county_id, county FROM counties"
    s["resolve_one_county_id"] = with_() + "SELECT county_id, county FROM counties WHERE county = 'Asia'"
    s["flatten_hierarchy"] = with_() + "SELECT county, sub_county, ward, facility_name FROM hierarchy"
    plain = "trim(regexp_replace({0}, '( County)|( Sub County)', ''))"
    s["org_unit_paths"] = "WITH RECURSIVE" + BASE + f""",
tree AS (
  SELECT id, {plain.format('name')} AS name, 0 AS depth, id AS path, {plain.format('name')} AS names
  FROM org_units WHERE parent_id IS NULL
  UNION ALL
  SELECT o.id, {plain.format('o.name')}, t.depth + 1, t.path || '/' || o.id, t.names || '/' || {plain.format('o.name')}
  FROM org_units o JOIN tree t ON o.parent_id = t.id
)
SELECT id, name, CAST(depth AS INTEGER) AS depth, path, names FROM tree"""
    s["assign_ward"] = with_(ASSIGNED) + f"SELECT {out_cols(FC_COLS + ['ward'])} FROM assigned"
    wb = f"b AS (SELECT county, sub_county, ward, {clean('tab')} AS k, {VAL} AS v FROM assigned WHERE funding = 'County')"
    s["requirements_by_ward"] = with_(ASSIGNED, wb) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["sub_county", "ward"], "k", sorted(CLEAN_LABELS)
    )
    wbt = (
        f"b AS (SELECT county, sub_county, ward, {clean('tab')} AS k, {mul(QTY, 'price_kes')} AS v "
        "FROM assigned WHERE funding = 'County')"
    )
    s["requirements_by_ward_totals"] = with_(ASSIGNED, wbt) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["sub_county", "ward"], "k", sorted(CLEAN_LABELS), row_total=True, col_total=True
    )
    wbn = (
        f"b AS (SELECT county, sub_county, ward, {clean('tab')} AS k, {mul(QTY, 'new_price_kes')} AS v "
        "FROM assigned_tn WHERE funding = 'County')"
    )
    s["requirements_by_ward_tn"] = with_(ASSIGNED_TN, wbn) + "SELECT * FROM " + crosstab(
        "b", ["county"], ["sub_county", "ward"], "k", sorted(CLEAN_LABELS)
    )
    s["unmatched_facilities"] = with_() + (
        "SELECT DISTINCT county, sub_county, facility_name FROM forecasts f "
        "WHERE NOT EXISTS (SELECT 1 FROM org_units o WHERE o.name IS NOT DISTINCT FROM f.facility_name)"
    )
    s["facilities_without_ward"] = with_(ASSIGNED) + (
        "SELECT DISTINCT county, sub_county, facility_name FROM assigned WHERE ward IS NULL"
    )
    s["facilities_by_level"] = with_() + (
        "SELECT county, sub_county, CASE WHEN regexp_matches(facility_name, '77$') THEN 'KEPH Level 4' "
        "ELSE keph_level END AS keph_level, facility_name "
        "FROM (SELECT DISTINCT county, sub_county, keph_level, facility_name FROM forecasts)"
    )

    s["facilities_by_level_ordered"] = with_() + (
        "SELECT county, sub_county, CASE WHEN regexp_matches(facility_name, '77$') THEN 'KEPH Level 4' "
        "ELSE keph_level END AS keph_level, facility_name, "
        "row_number() OVER (PARTITION BY county ORDER BY sub_county, keph_level, facility_name) AS position "
        "FROM (SELECT DISTINCT county, sub_county, keph_level, facility_name FROM forecasts)"
    )

    tp = f"""tp AS (
  SELECT county, {clean('tab')} AS tab, {IT}, v FROM
    (SELECT county, tab, {IT}, coalesce(sum({VAL}), 0) AS v FROM forecasts GROUP BY county, tab, {IT})
)"""
    s["top_products"] = with_(tp) + (
        f"SELECT county, tab, {IT}, {dbl('v')} AS {VAL} FROM ("
        + _top("tp", "county, tab", "v DESC NULLS LAST", 5, "rank()")
        + ")"
    )
    s["products_by_category_tn"] = with_(PRODUCTS_TN) + "SELECT * FROM ptn"
    s["max_product_per_category_tn"] = with_(PRODUCTS_TN) + _top(
        "ptn", "county, tab", f"{VAL} DESC NULLS LAST", 1, "rank()"
    )
    s["bottom_products_per_category_tn"] = with_(PRODUCTS_TN) + _top(
        "ptn", "county, tab", f"{VAL} ASC NULLS LAST", 5, "rank()"
    )
    s["products_report_tn"] = with_(PRODUCTS_TN) + (
        f"SELECT county, tab, {IT}, format('{{:,.0f}}', {VAL}) AS {VAL} FROM ("
        f"SELECT county, tab, {IT}, {VAL} FROM ptn UNION ALL "
        f"SELECT county, 'Total', '-', {dbl(f'sum(CAST({VAL} AS {M}))')} FROM ptn GROUP BY county)"
    )

    tc = f"""tc AS (
  SELECT f.county, c.product_classification, coalesce(sum(f.{VAL}), 0) AS v
  FROM forecasts f LEFT JOIN classes c ON {join_cls()} WHERE f.funding = 'County' GROUP BY 1, 2
)"""
    s["top_categories"] = with_(tc) + (
        f"SELECT county, product_classification, {dbl('v')} AS {VAL} FROM ("
        + _top(
            "(SELECT * FROM tc WHERE product_classification IS NOT NULL)",
            "county",
            "v DESC NULLS LAST, product_classification ASC NULLS LAST",
            10,
        )
        + ")"
    )
    lvl = f"""b AS (
  SELECT f.county, c.product_classification, f.keph_level AS k, f.{VAL} AS v
  FROM forecasts f LEFT JOIN classes c ON {join_cls()}
  WHERE f.funding = 'County' AND c.product_classification IS NOT NULL
),
w AS {crosstab('b', ['county'], ['product_classification'], 'k', KEPH, fill=False, col_total=True)}"""
    s["top_categories_by_level"] = with_(lvl) + _top(
        "w", "county", '"Total" DESC NULLS LAST, product_classification ASC NULLS LAST', 10
    )
    tv = f"""b AS (
  SELECT f.county, c.product_classification, coalesce(f.ven, 'NA') AS k, f.{VAL} AS v
  FROM resolved_left f LEFT JOIN classes c ON {join_cls()}
  WHERE f.funding = 'County' AND c.product_classification IS NOT NULL
),
w AS {crosstab('b', ['county'], ['product_classification'], 'k', ['V', 'E', 'N', 'NA'], col_total=True)}"""
    s["top_categories_by_ven"] = with_(RESOLVED_LEFT, tv) + _top(
        "w", "county", '"Total" DESC NULLS LAST, product_classification ASC NULLS LAST', 10
    )
    def table(sql_top: str, cols: list[str]) -> str:
        fmt = ", ".join(f"format('{{:,.0f}}', {q(c)}) AS {q(c)}" for c in cols)
        return f"SELECT county, product_classification AS \"Product Category\", {fmt} FROM ({sql_top})"

    s["top_categories_by_level_table"] = with_(lvl) + table(
        _top("w", "county", '"Total" DESC NULLS LAST, product_classification ASC NULLS LAST', 10), [*KEPH, "Other", "Total"]
    )
    s["top_categories_by_ven_table"] = with_(RESOLVED_LEFT, tv) + table(
        _top("w", "county", '"Total" DESC NULLS LAST, product_classification ASC NULLS LAST', 10),
        ["V", "E", "N", "NA", "Other", "Total"],
    )
    s["clean_categorisation"] = with_() + (
        f"SELECT n.item_name AS {IT}, n.product_category AS tab, n.product_or_equipment FROM new_cat n "
        f"WHERE n.item_name IN (SELECT {IT} FROM classes WHERE product_or_equipment IS NULL) "
        f"UNION ALL SELECT {IT}, tab, product_or_equipment FROM classes WHERE product_or_equipment IS NOT NULL"
    )
    s["workload_extract"] = with_(WORK_EXTRACT) + "SELECT * FROM wx"
    s["workload_extract_one_county"] = with_() + (
        "SELECT a.* FROM analytics a WHERE period = '2024' AND data IN ('signup', 'view', 'click', 'purchase') "
        "AND facility_ownership IN ('O0', 'O2') AND keph_level IN ('K1', 'K2', 'K4') AND organisation_unit IN "
        "(SELECT facility_id FROM organisation_units WHERE lower(county_name) = 'asia')"
    )
    s["workload_aggregate"] = with_(WORK_EXTRACT, WORK_AGG) + "SELECT * FROM wa"
    s["workload_aggregate_landed"] = s["workload_aggregate"]
    s["workload_enrich"] = with_(WORK_EXTRACT, WORK_AGG, WORK_ENRICH) + "SELECT * FROM we"
    s["workload_report"] = with_(WORK_EXTRACT, WORK_AGG, WORK_ENRICH) + (
        "SELECT keph_level, sub_county, facility_name, total_workload AS workload, mfl_code, facility_ownership FROM we"
    )
    s["ven_gaps"] = with_(ITEM_FIRST) + "SELECT * FROM ifirst WHERE ven IS NULL"
    s["classification_coverage_items"] = with_() + (
        f"SELECT l.{IT}, c.tab, c.product_or_equipment, c.product_classification, c.rmnch_product, c.moh_647_name "
        f"FROM (SELECT DISTINCT {IT} FROM forecasts) l JOIN classes c ON {nse('l.' + IT, 'c.' + IT)}"
    )
    s["classification_coverage_first"] = with_(ITEM_FIRST) + (
        f"SELECT l.{IT}, l.tab, l.ven, {CLASS_COLS} FROM ifirst l JOIN classes c ON {nse('l.' + IT, 'c.' + IT)}"
    )
    one = ITEM_FIRST.replace("ifirst AS", "ione AS").replace("FROM forecasts)", "FROM forecasts WHERE lower(county) = 'asia')")
    s["classification_coverage_one_county"] = with_(one) + (
        f"SELECT l.{IT}, l.tab, l.ven, {CLASS_COLS} FROM ione l JOIN classes c ON {nse('l.' + IT, 'c.' + IT)}"
    )
    s["rmnch_catalogue"] = with_() + f"SELECT * FROM classes WHERE {IT} IN (SELECT product FROM rmnch)"
    s["facility_counts_hierarchy"] = with_() + "SELECT county, facility_name, count(*) AS n FROM hierarchy GROUP BY 1, 2"
    s["facility_counts_forecasts"] = with_() + "SELECT county, facility_name, count(*) AS n FROM forecasts GROUP BY 1, 2"
    s["facility_search"] = with_() + (
        "SELECT county, sub_county, ward, facility_name FROM hierarchy "
        "WHERE regexp_matches(facility_name, '#0+1[0-9]$') OR sub_county = 'NATION_3'"
    )
    s["county_grand_total"] = with_() + (
        f"SELECT county, {dbl(f'coalesce(sum({mul(QTY, 'price_kes')}), 0)')} AS {VAL} "
        "FROM forecasts WHERE funding = 'County' GROUP BY county"
    )
    s["distinct_org_units"] = with_() + "SELECT DISTINCT county, sub_county, facility_name FROM forecasts"
    s["unclassified_rows"] = with_() + (
        f"SELECT {out_cols(FC_COLS, 'f')}, {poe_defaults('c.product_or_equipment', 'f.tab')} AS product_or_equipment "
        f"FROM forecasts f LEFT JOIN classes c ON {join_cls()} "
        f"WHERE f.funding = 'County' AND {poe_defaults('c.product_or_equipment', 'f.tab')} IS NULL"
    )
    s["source_ordered_items"] = with_() + (
        f"SELECT {IT}, tab, ven, position FROM (SELECT *, row_number() OVER (PARTITION BY {IT} ORDER BY position) AS k FROM ("
        f"SELECT {IT}, tab, ven, row_number() OVER (ORDER BY source_row, {IT}, tab, ven) AS position FROM forecasts_tn)) WHERE k = 1"
    )
    s["item_run_ids"] = with_() + (
        f"SELECT sub_county, source_row, {IT}, CAST(sum(chg) OVER (ORDER BY source_row, {IT} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS id FROM ("
        f"SELECT sub_county, source_row, {IT}, CASE WHEN row_number() OVER (ORDER BY source_row, {IT}) > 1 "
        f"AND lag({IT}) OVER (ORDER BY source_row, {IT}) IS NOT DISTINCT FROM {IT} THEN 0 ELSE 1 END AS chg "
        "FROM forecasts_tn)"
    )
    return s


ORACLE_SQL: dict[str, str] = _sql()
