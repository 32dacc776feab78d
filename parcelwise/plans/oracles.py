"""SQL counterparts of the registered queries, for an independent engine.

Each text restates the definition in closed form; none is generated from the
Spark plans.
"""

from __future__ import annotations

from .. import fixed_values as fixed
from ..sources.homes import CANONICAL, HOMES_BAD_SQL, HOMES_SQL

NUMBERS = [
    "pid", "sale_price", "overall_qual", "overall_cond", "year_built", "year_remod_add", "yr_sold", "mo_sold",
    "gr_liv_area", "total_bsmt_sf", "first_flr_sf", "second_flr_sf", "full_bath", "half_bath", "bsmt_full_bath",
    "bsmt_half_bath", "garage_cars", "garage_area", "fireplaces", "open_porch_sf", "enclosed_porch",
    "three_ssn_porch", "screen_porch", "lot_frontage", "lot_area", "pool_area",
]
LABELS = ["alley", "garage_type", "exter_qual", "ms_zoning", "neighborhood"]
ALL = list(CANONICAL)
DOUBLES = {
    "sale_price", "gr_liv_area", "total_bsmt_sf", "first_flr_sf", "second_flr_sf", "bsmt_full_bath", "bsmt_half_bath",
    "garage_cars", "garage_area", "open_porch_sf", "enclosed_porch", "three_ssn_porch", "screen_porch",
    "lot_frontage", "lot_area", "pool_area",
}
GAPPED_NUMBERS = ["year_remod_add", "total_bsmt_sf", "bsmt_full_bath", "garage_cars", "garage_area", "lot_frontage"]
GAPPED_LABELS = ["alley", "garage_type", "exter_qual"]

ORACLES: dict[str, str] = {}


def homes(rest: str, bad: bool = False) -> str:
    extra = f", homes_bad AS ({HOMES_BAD_SQL})" if bad else ""
    return f"WITH homes AS ({HOMES_SQL}){extra}{rest if rest.startswith(',') else ' ' + rest}"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def r(x: str, digits: int = 6) -> str:
    return f"(round({x}, {digits}) + 0.0E0)"


def mode(column: str, source: str = "homes") -> str:
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def draw(key: str) -> str:
    return f"(('0x' || substr(md5({key} || '#42'), 1, 15))::BIGINT / 1152921504606846976.0E0)"


def split_of(key: str) -> str:
    return f"CASE WHEN {draw(key)} < 0.15E0 THEN 'val' WHEN {draw(key)} < 0.3E0 THEN 'test' ELSE 'train' END"


def rounded_columns(names: list[str]) -> str:
    return ", ".join(f"{r(n)} AS {n}" if n in DOUBLES else n for n in names)


# --- source and flagship
ORACLES["homes_view"] = HOMES_SQL
ORACLES["csv_scan"] = HOMES_SQL
ORACLES["price_by_group"] = homes("""
, valid AS (
  SELECT * FROM homes WHERE sale_price > 0 AND sale_price < 2000000 AND gr_liv_area > 0 AND overall_qual BETWEEN 1 AND 10
   AND overall_cond BETWEEN 1 AND 10 AND year_built BETWEEN 1800 AND 2025 AND yr_sold BETWEEN 2006 AND 2010
   AND mo_sold BETWEEN 1 AND 12 AND coalesce(lot_area > 0, true) AND coalesce(garage_cars BETWEEN 0 AND 10, true)
   AND coalesce(garage_area >= 0, true) AND coalesce(total_bsmt_sf >= 0, true)),
q AS (SELECT quantile_cont(sale_price, 0.25) AS q1, quantile_cont(sale_price, 0.75) AS q3 FROM valid),
m AS (SELECT neighborhood, count(*) AS n, median(sale_price) AS med FROM valid, q
 WHERE sale_price BETWEEN q1 - 1.5E0 * (q3 - q1) AND q3 + 1.5E0 * (q3 - q1) GROUP BY 1),
k AS (SELECT *, row_number() OVER (ORDER BY med DESC, neighborhood) AS top, row_number() OVER (ORDER BY med, neighborhood) AS low FROM m)
SELECT 'highest' AS "end", neighborhood AS "Neighborhood", n, """.strip() + r("med", 2) + """ AS median FROM k WHERE top <= 5
UNION ALL SELECT 'lowest', neighborhood, n, """ + r("med", 2) + " FROM k WHERE low <= 5")
ORACLES["normalise_names"] = homes("SELECT " + ", ".join(f'{k} AS "{v}"' for k, v in CANONICAL.items()) + " FROM homes")
ORACLES["unmapped_labels"] = """
SELECT 'status' AS "column", count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS n_unmapped FROM orders
UNION ALL SELECT 'priority', count(o_orderpriority) FROM orders"""

# --- splits
BINS = """, e AS (SELECT quantile_cont(sale_price, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM homes),
b AS (SELECT pid, sale_price, CAST((sale_price > q[2])::INT + (sale_price > q[3])::INT + (sale_price > q[4])::INT + (sale_price > q[5])::INT AS INT) AS bin
 FROM homes, e)"""
STRATA = BINS + """, o AS (SELECT pid, sale_price, row_number() OVER (PARTITION BY bin ORDER BY md5(pid || '#42'), pid) AS k, count(*) OVER (PARTITION BY bin) AS n FROM b),
t AS (SELECT *, round(n * 0.15E0) AS nt FROM o),
s AS (SELECT pid, sale_price, CASE WHEN k <= nt THEN 'test' WHEN k <= nt + round((n - nt) * (0.15E0 / 0.85E0)) THEN 'val' ELSE 'train' END AS split FROM t)"""
ORACLES["quintile_bins"] = homes(BINS + " SELECT pid, bin FROM b")
ORACLES["stratified_split"] = homes(STRATA + " SELECT pid, split FROM s")
ORACLES["parquet_splits"] = homes(STRATA + " SELECT pid, sale_price FROM s WHERE split = 'val'")
ORACLES["stratified_split_fractions"] = homes(
    f"SELECT pid, CASE WHEN {draw('pid')} < 0.15E0 THEN 'test' WHEN {draw('pid')} < 0.15E0 + 0.15E0 THEN 'val' ELSE 'train' END AS split FROM homes")
ORACLES["random_split"] = f"SELECT o_orderkey, {split_of('o_orderkey')} AS split FROM orders"
FOLD = "CAST(('0x' || substr(md5({key} || '#42'), 1, 8))::BIGINT % 5 AS INT)"
ORACLES["fold_assignment"] = f"SELECT o_orderkey, {FOLD.format(key='o_orderkey')} AS fold FROM orders"

# --- contracts
BAD_RULES = [
    ("SalePrice", "not null", "sale_price IS NULL", "CAST(sale_price AS VARCHAR)"),
    ("SalePrice", "> 0", "sale_price <= 0", "CAST(sale_price AS VARCHAR)"),
    ("SalePrice", "< 2000000", "sale_price >= 2000000", "CAST(sale_price AS VARCHAR)"),
    ("Overall Qual", "not null", "overall_qual IS NULL", "CAST(overall_qual AS VARCHAR)"),
    ("Overall Qual", "in [1, 10]", "overall_qual NOT BETWEEN 1 AND 10", "CAST(overall_qual AS VARCHAR)"),
    ("Year Built", "is long", "year_built_text IS NOT NULL AND try_cast(year_built_text AS BIGINT) IS NULL", "year_built_text"),
    ("Year Built", "not null", "year_built_text IS NULL", "year_built_text"),
    ("Year Built", ">= 1800", "try_cast(year_built_text AS BIGINT) < 1800", "year_built_text"),
    ("Year Built", "<= 2025", "try_cast(year_built_text AS BIGINT) > 2025", "year_built_text"),
    ("Yr Sold", "not null", "yr_sold IS NULL", "CAST(yr_sold AS VARCHAR)"),
    ("Yr Sold", "one of 2006, 2007, 2008, 2009, 2010", "yr_sold NOT IN (2006, 2007, 2008, 2009, 2010)", "CAST(yr_sold AS VARCHAR)"),
    ("Garage Cars", "in [0, 10]", "garage_cars NOT BETWEEN 0 AND 10", "CAST(garage_cars AS VARCHAR)"),
]
ANY_BAD = " OR ".join(f"coalesce({x[2]}, false)" for x in BAD_RULES)
ORACLES["contract_violations"] = homes(union([
    f"""SELECT pid, '{a}' AS "column", '{b}' AS "check", {v} AS value FROM homes_bad WHERE {x}""" for a, b, x, v in BAD_RULES]), bad=True)
ORACLES["contract_counts"] = homes(union([
    f"""SELECT '{a}' AS "column", '{b}' AS "check", count(*) FILTER ({x}) AS n FROM homes_bad""" for a, b, x, _ in BAD_RULES]), bad=True)
ORACLES["contract_valid"] = homes(
    f"""SELECT pid, sale_price AS "SalePrice", CAST(overall_qual AS DOUBLE) AS "Overall Qual", CAST(yr_sold AS BIGINT) AS "Yr Sold",
 CAST(year_built_text AS BIGINT) AS "Year Built", garage_cars AS "Garage Cars" FROM homes_bad WHERE NOT ({ANY_BAD})""", bad=True)
ORACLES["contract_quarantine"] = homes(
    f"SELECT pid, CAST({' + '.join(f'coalesce({x[2]}, false)::INT' for x in BAD_RULES)} AS INT) AS n_reasons FROM homes_bad WHERE {ANY_BAD}", bad=True)
HOMES_RULES = [
    ("SalePrice", "not null", "sale_price IS NULL"), ("SalePrice", "> 0", "sale_price <= 0"), ("SalePrice", "< 2000000", "sale_price >= 2000000"),
    ("Gr Liv Area", "not null", "gr_liv_area IS NULL"), ("Gr Liv Area", "> 0", "gr_liv_area <= 0"),
    ("Overall Qual", "not null", "overall_qual IS NULL"), ("Overall Qual", "in [1, 10]", "overall_qual NOT BETWEEN 1 AND 10"),
    ("Overall Cond", "not null", "overall_cond IS NULL"), ("Overall Cond", "in [1, 10]", "overall_cond NOT BETWEEN 1 AND 10"),
    ("Year Built", "not null", "year_built IS NULL"), ("Year Built", ">= 1800", "year_built < 1800"), ("Year Built", "<= 2025", "year_built > 2025"),
    ("Yr Sold", "not null", "yr_sold IS NULL"), ("Yr Sold", "one of 2006, 2007, 2008, 2009, 2010", "yr_sold NOT BETWEEN 2006 AND 2010"),
    ("Mo Sold", "not null", "mo_sold IS NULL"), ("Mo Sold", "one of 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12", "mo_sold NOT BETWEEN 1 AND 12"),
    ("Lot Area", "> 0", "lot_area <= 0"), ("Garage Cars", "in [0, 10]", "garage_cars NOT BETWEEN 0 AND 10"),
    ("Garage Area", ">= 0", "garage_area < 0"), ("Total Bsmt SF", ">= 0", "total_bsmt_sf < 0"),
]
ORACLES["homes_contract_counts"] = homes(union(
    ["""SELECT 'Sale Condition' AS "column", 'column exists' AS "check", 1 AS n"""]
    + [f"SELECT '{a}', '{b}', count(*) FILTER ({x}) FROM homes" for a, b, x in HOMES_RULES]))

# --- profile
ORACLES["missing_profile"] = homes("SELECT * FROM (" + union([
    f"""SELECT '{n}' AS "column", count(*) FILTER ({n} IS NULL) AS n_missing, {r(f'avg(({n} IS NULL)::INT)')} AS fraction,
 {r(f'100 * avg(({n} IS NULL)::INT)', 2)} AS percent FROM homes""" for n in ALL]) + ") WHERE n_missing > 0")
LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
ORACLES["schema_report"] = union([
    f"""SELECT '{n}' AS "column", '{t}' AS dtype, count({n}) AS non_null, count(*) AS n_rows FROM lineitem""" for n, t in LINEITEM_TYPES.items()])
ORACLES["value_ranges"] = homes(union([
    f"""SELECT '{n}' AS "column", CAST(min({n}) AS DOUBLE) AS min, CAST(max({n}) AS DOUBLE) AS max FROM homes""" for n in NUMBERS]))
ORACLES["skew_profile"] = homes(union([f"""SELECT '{n}' AS "column", {r(f'skewness({n})')} AS skewness FROM homes""" for n in NUMBERS]))
ORACLES["skew_events"] = f"""SELECT 'value' AS "column", {r('skewness(value)')} AS skewness FROM events"""
ORACLES["skew_documents"] = f"""SELECT 'n_chars' AS "column", {r('skewness(n_chars)')} AS skewness FROM documents"""


def describe(source: str, numbers: list[str], labels: list[str]) -> str:
    none = "CAST(NULL AS DOUBLE)"
    parts = [
        f"""SELECT '{n}' AS "column", count({n}) AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,
 {r(f'avg({n})', 4)} AS mean, {r(f'stddev_samp({n})', 4)} AS std, {r(f'CAST(min({n}) AS DOUBLE)', 4)} AS min,
 {r(f'quantile_cont(CAST({n} AS DOUBLE), 0.25)', 4)} AS p25, {r(f'quantile_cont(CAST({n} AS DOUBLE), 0.5)', 4)} AS p50,
 {r(f'quantile_cont(CAST({n} AS DOUBLE), 0.75)', 4)} AS p75, {r(f'CAST(max({n}) AS DOUBLE)', 4)} AS max FROM {source}""" for n in numbers]
    parts += [
        f"""SELECT '{n}', count({n}), count(DISTINCT {n}), {mode(n, source)},
 (SELECT count(*) FROM {source} WHERE {n} IS NOT NULL GROUP BY {n} ORDER BY count(*) DESC LIMIT 1),
 {none}, {none}, {none}, {none}, {none}, {none}, {none} FROM {source}""" for n in labels]
    return union(parts)


ORACLES["describe_all"] = homes(describe("homes", NUMBERS, LABELS))
ORACLES["describe_lineitem"] = describe("lineitem", list(LINEITEM_TYPES)[:8], ["l_returnflag", "l_linestatus"])
ORACLES["target_summary"] = homes(
    f"""SELECT count(sale_price) AS count, {r('avg(sale_price)', 4)} AS mean, {r('median(sale_price)', 4)} AS median,
 {r('stddev_samp(sale_price)', 4)} AS std, {r('min(sale_price)', 4)} AS min, {r('quantile_cont(sale_price, 0.25)', 4)} AS p25,
 {r('quantile_cont(sale_price, 0.75)', 4)} AS p75, {r('max(sale_price)', 4)} AS max FROM homes""")
ORACLES["category_counts"] = homes(union([
    f"""SELECT '{n}' AS "column", {n} AS value, count(*) AS n FROM homes WHERE {n} IS NOT NULL GROUP BY {n}""" for n in LABELS]))
ORACLES["label_shares"] = union([
    f"""SELECT '{n}' AS "column", {n} AS value, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()')} AS share
 FROM part WHERE {n} IS NOT NULL GROUP BY {n}""" for n in ("p_brand", "p_type")])
ORDER_TEXT = " || '|' || ".join(
    f"coalesce(CAST(length(CAST({n} AS VARCHAR)) AS VARCHAR) || '=' || CAST({n} AS VARCHAR), '~')"
    for n in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
ORACLES["fingerprint"] = f"SELECT count(*) AS n_rows, CAST(sum(('0x' || substr(md5({ORDER_TEXT}), 1, 15))::BIGINT) AS VARCHAR) AS fingerprint FROM orders"
ORACLES["group_quartiles"] = ORACLES["group_quartiles_narrowed"] = f"""
SELECT l_returnflag, count(l_extendedprice) AS n, {r('quantile_cont(l_extendedprice, 0.25)', 4)} AS p25,
 {r('median(l_extendedprice)', 4)} AS p50, {r('quantile_cont(l_extendedprice, 0.75)', 4)} AS p75 FROM lineitem GROUP BY 1"""

# --- correlation
FACTORS = NUMBERS[2:]
RANK = union([f"""SELECT '{n}' AS "column", corr({n}, sale_price) AS corr FROM homes""" for n in FACTORS])
ORACLES["corr_rank"] = homes(f"""SELECT "column", {r('corr')} AS corr FROM ({RANK}) ORDER BY corr DESC, "column" LIMIT 10""")
MATRIX = union([f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS corr FROM homes" for a in NUMBERS[1:] for b in NUMBERS[1:]])
ORACLES["corr_matrix"] = homes(f"SELECT x, y, {r('corr')} AS corr FROM ({MATRIX})")
ORACLES["corr_top_matrix"] = homes(
    f""", top AS (SELECT "column" AS c FROM ({RANK}) ORDER BY corr DESC, "column" LIMIT 10)
 SELECT x, y, {r('corr')} AS corr FROM ({MATRIX}) WHERE x IN (SELECT c FROM top) AND y IN (SELECT c FROM top)""")
LINE_FACTORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLES["corr_lineitem"] = union([
    f"SELECT '{a}' AS x, '{b}' AS y, {r(f'corr({a}, {b})')} AS corr FROM lineitem"
    for i, a in enumerate(LINE_FACTORS) for b in LINE_FACTORS[i + 1:]])

NAN_LINES = "WITH lines AS (SELECT l_quantity, CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS price FROM lineitem) "
ORACLES["target_summary_nan"] = NAN_LINES + (
    f"""SELECT count(price) AS count, {r('avg(price)', 4)} AS mean, {r('median(price)', 4)} AS median, {r('stddev_samp(price)', 4)} AS std,
 {r('min(price)', 4)} AS min, {r('quantile_cont(price, 0.25)', 4)} AS p25, {r('quantile_cont(price, 0.75)', 4)} AS p75, {r('max(price)', 4)} AS max FROM lines""")
ORACLES["corr_nan"] = NAN_LINES + f"SELECT 'l_quantity' AS x, 'price' AS y, {r('corr(l_quantity, price)')} AS corr FROM lines"
ORACLES["histogram_nan"] = NAN_LINES + """SELECT CAST(floor(price / 2500.0E0) AS BIGINT) AS bin, floor(price / 2500.0E0) * 2500.0E0 AS lower,
 floor(price / 2500.0E0) * 2500.0E0 + 2500.0E0 AS upper, count(*) AS n FROM lines WHERE price IS NOT NULL GROUP BY 1, 2, 3"""
ORACLES["csv_orders"] = "SELECT 9000000000000000000 + o_orderkey AS id, o_totalprice, o_orderpriority FROM orders"
TYPED_ORDERS = """WITH t AS (SELECT o_orderkey, o_orderkey % 5 AS k, 1990 + o_orderkey % 50 AS year, o_orderkey % 7 = 0 AS large, o_orderkey % 10 AS n FROM orders) """
ORACLES["contract_overflow_counts"] = TYPED_ORDERS + union([
    f"""SELECT '{column}' AS "column", '{check}' AS "check", count(*) FILTER ({fails}) AS n FROM t""" for column, check, fails in (
        ("year", "is int", "k IN (0, 1)"), ("year", "not null", "k = 2"), ("year", "in [1800, 2025]", "k IN (3, 4) AND year > 2025"),
        ("n", "is int", "large"), ("n", "not null", "false"), ("n", "<= 5", "NOT large AND n > 5"))])
ORACLES["contract_overflow_valid"] = TYPED_ORDERS + "SELECT o_orderkey, year, n FROM t WHERE k IN (3, 4) AND year <= 2025 AND NOT large AND n <= 5"

# --- plot data
ORACLES["histogram_fixed"] = """SELECT CAST(floor(l_extendedprice / 2500.0E0) AS BIGINT) AS bin, floor(l_extendedprice / 2500.0E0) * 2500.0E0 AS lower,
 floor(l_extendedprice / 2500.0E0) * 2500.0E0 + 2500.0E0 AS upper, count(*) AS n FROM lineitem GROUP BY 1, 2, 3"""
ORACLES["histogram_auto"] = homes(f"""
, s AS (SELECT count(*) AS n, min(sale_price) AS lo, max(sale_price) AS hi, quantile_cont(sale_price, 0.75) - quantile_cont(sale_price, 0.25) AS iqr FROM homes),
w AS (SELECT lo, hi, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr * pow(n, -1.0E0 / 3))) AS bins FROM s),
v AS (SELECT lo, (hi - lo) / bins AS width, bins FROM w),
b AS (SELECT lo, width, least(CAST(floor((sale_price - lo) / width) AS BIGINT), CAST(bins AS BIGINT) - 1) AS bin FROM homes, v)
SELECT bin, {r('lo + bin * width')} AS lower, {r('lo + bin * width + width')} AS upper, count(*) AS n FROM b GROUP BY 1, 2, 3""".strip())
ORACLES["group_histogram"] = homes("""SELECT neighborhood, CAST(floor(sale_price / 50000.0E0) AS BIGINT) AS bin, floor(sale_price / 50000.0E0) * 50000.0E0 AS lower,
 floor(sale_price / 50000.0E0) * 50000.0E0 + 50000.0E0 AS upper, count(*) AS n FROM homes GROUP BY 1, 2, 3, 4""")
BANDS = " ".join(f"WHEN sale_price < {hi}E0 THEN {i}" for i, hi in enumerate(fixed.PRICE_BANDS[1:]))
ORACLES["price_bands"] = homes(f""", b AS (SELECT CASE {BANDS} ELSE {len(fixed.PRICE_BANDS) - 1} END AS band FROM homes WHERE sale_price >= 0)
 SELECT CAST(band AS BIGINT) AS band, ([{', '.join(f'{e}E0' for e in fixed.PRICE_BANDS)}])[band + 1] AS lower, count(*) AS n,
 {r('count(*) / (SELECT count(sale_price) FROM homes)')} AS share FROM b GROUP BY 1, 2""")
CURVE = f"""g AS (SELECT CAST(unnest(generate_series(0, 199)) AS INT) AS point)
 SELECT point, {r('lo + point * ((hi - lo) / 199)', 4)} AS x,
 {r('sum(w * exp(-0.5E0 * pow((lo + point * ((hi - lo) / 199) - v) / h, 2))) / (n * h * sqrt(2 * pi())) * 1e6')} AS density_e6
 FROM pts, g, s GROUP BY point, lo, hi, h, n"""


def linear_bins(value: str, table: str, fine: int) -> str:
    """``s`` and ``pts``: every value split over two points of a grid of ``fine`` steps."""
    return f"""s AS (SELECT count({value}) AS n, min({value}) AS lo, max({value}) AS hi, stddev_samp({value}) * pow(count({value}), -0.2E0) AS h FROM {table}),
spots AS (SELECT least(greatest(({value} - lo) / ((hi - lo) / {fine}), 0), {fine}) AS spot, lo, hi FROM {table}, s WHERE {value} IS NOT NULL),
cut AS (SELECT least(floor(spot), {fine - 1}) AS l, spot, lo, hi FROM spots),
laid AS (SELECT l AS k, 1 - (spot - l) AS w, lo, hi FROM cut UNION ALL SELECT l + 1, spot - l, lo, hi FROM cut),
pts AS (SELECT lo + k * ((hi - lo) / {fine}) AS v, sum(w) AS w FROM laid GROUP BY k, lo, hi), {CURVE}"""


ORACLES["density_curve"] = homes(f""", s AS (SELECT count(*) AS n, min(sale_price) AS lo, max(sale_price) AS hi,
 stddev_samp(sale_price) * pow(count(*), -0.2E0) AS h FROM homes), pts AS (SELECT sale_price AS v, 1 AS w FROM homes), {CURVE}""")
ORACLES["density_curve_binned"] = "WITH " + linear_bins("l_extendedprice", "lineitem", 3 * 199)
ORACLES["scatter_bins"] = homes("""SELECT CAST(floor(gr_liv_area / 200.0E0) AS BIGINT) AS x_bin, CAST(floor(sale_price / 25000.0E0) AS BIGINT) AS y_bin,
 count(*) AS n FROM homes WHERE gr_liv_area IS NOT NULL AND sale_price IS NOT NULL GROUP BY 1, 2""")
ORACLES["regression_line"] = homes(f"""SELECT count(*) AS n, {r('regr_slope(sale_price, gr_liv_area)', 4)} AS slope,
 {r('regr_intercept(sale_price, gr_liv_area)', 4)} AS intercept, {r('min(sale_price)', 4)} AS low, {r('max(sale_price)', 4)} AS high
 FROM homes WHERE gr_liv_area IS NOT NULL AND sale_price IS NOT NULL""")

# --- cleaning
ORACLES["drop_high_missing"] = homes("SELECT * EXCLUDE (alley) FROM homes")
ORACLES["drop_high_missing_listed"] = homes(
    "SELECT " + ", ".join(f'{k} AS "{v}"' for k, v in CANONICAL.items() if k not in ("pid", "alley")) + ", pid AS key FROM homes")


def filled(number, label) -> str:
    fills = {n: f"{r(f'coalesce(CAST({n} AS DOUBLE), {number(n)})')} AS {n}" for n in GAPPED_NUMBERS}
    fills |= {n: f"coalesce({n}, {label(n)}) AS {n}" for n in GAPPED_LABELS}
    return homes("SELECT " + ", ".join(fills.get(n) or (f"{r(n)} AS {n}" if n in DOUBLES else n) for n in ALL) + " FROM homes")


ORACLES["impute_median"] = filled(lambda n: f"(SELECT median({n}) FROM homes)", mode)
ORACLES["impute_mean"] = filled(lambda n: f"(SELECT avg({n}) FROM homes)", mode)
ORACLES["impute_mode"] = filled(mode, mode)
ORACLES["impute_constant"] = filled(lambda n: "0.0E0", lambda n: "'missing'")
ORACLES["iqr_filter"] = homes(""", q AS (SELECT quantile_cont(sale_price, 0.25) AS q1, quantile_cont(sale_price, 0.75) AS q3 FROM homes)
 SELECT pid, sale_price, neighborhood FROM homes, q WHERE sale_price BETWEEN q1 - 1.5E0 * (q3 - q1) AND q3 + 1.5E0 * (q3 - q1)""")
ORACLES["outlier_report"] = f"""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
b AS (SELECT q1 - 1.5E0 * (q3 - q1) AS lo, q3 + 1.5E0 * (q3 - q1) AS hi FROM q)
SELECT count(*) AS n_rows, count(*) FILTER (value BETWEEN lo AND hi) AS n_kept, count(*) FILTER (NOT (value BETWEEN lo AND hi)) AS n_removed,
 {r('any_value(lo)', 4)} AS lower, {r('any_value(hi)', 4)} AS upper FROM events, b"""
ORACLES["narrow_types"] = "SELECT CAST(c_custkey AS INT) AS c_custkey, c_nationkey, CAST(c_acctbal AS FLOAT) AS c_acctbal FROM customer"

# --- features and encoders
DERIVED = {
    "TotalSF": "total_bsmt_sf + first_flr_sf + second_flr_sf",
    "TotalBath": "full_bath + 0.5E0 * half_bath + bsmt_full_bath + 0.5E0 * bsmt_half_bath",
    "PorchSF": "open_porch_sf + enclosed_porch + three_ssn_porch + screen_porch",
    "HouseAge": "CASE WHEN yr_sold - year_built < 0 THEN 0 ELSE yr_sold - year_built END",
    "RemodelAge": "CASE WHEN yr_sold - year_remod_add < 0 THEN 0 ELSE yr_sold - year_remod_add END",
    "IsRemodeled": "CASE WHEN year_built = year_remod_add THEN 0 ELSE 1 END",
    "QualCond": "overall_qual * overall_cond",
    "GarageScore": "garage_cars * garage_area",
    "HasPool": "CASE WHEN pool_area > 0 THEN 1 ELSE 0 END",
    "HasFireplace": "CASE WHEN fireplaces > 0 THEN 1 ELSE 0 END",
    "HasGarage": "CASE WHEN garage_area > 0 THEN 1 ELSE 0 END",
    "HasBasement": "CASE WHEN total_bsmt_sf > 0 THEN 1 ELSE 0 END",
    "LotToLivRatio": "coalesce(lot_area / nullif(gr_liv_area, 0), 0)",
}
WHOLE = {"HouseAge", "RemodelAge", "IsRemodeled", "QualCond", "HasPool", "HasFireplace", "HasGarage", "HasBasement"}
ORACLES["domain_features"] = homes(
    "SELECT pid, " + ", ".join(f"{x if n in WHOLE else r(x)} AS \"{n}\"" for n, x in DERIVED.items()) + " FROM homes")


def logged(n: str, x: str | None = None, source: str = "homes") -> str:
    """ln(1 + max(x, 0)) where the column's skewness is above the threshold, decided by the data."""
    x = x or n
    return f"CASE WHEN abs((SELECT skewness({n}) FROM {source})) > 0.75 THEN ln(1 + greatest(CAST({x} AS DOUBLE), 0)) ELSE {x} END"


ORACLES["log_skewed"] = homes("SELECT " + ", ".join(
    n if n not in DOUBLES else f"{r(n)} AS {n}" if n == "sale_price" else f"CASE WHEN {n} IS NULL THEN NULL ELSE {r(logged(n))} END AS {n}" for n in ALL) + " FROM homes")
ORACLES["log_target"] = homes(f"SELECT pid, {r('ln(1 + sale_price)')} AS log_price, {r('exp(ln(1 + sale_price)) - 1', 4)} AS price FROM homes")


def kept(n: str, source: str, threshold: float) -> str:
    return f"(SELECT {n} FROM {source} WHERE {n} IS NOT NULL GROUP BY {n} HAVING count(*) >= {threshold}E0 * (SELECT count({n}) FROM {source}))"


ORACLES["rare_labels"] = homes("SELECT pid, " + ", ".join(
    f"CASE WHEN {n} IN {kept(n, 'homes', 0.01)} THEN {n} ELSE 'Other' END AS {n}"
    for n in ("ms_zoning", "exter_qual", "garage_type", "neighborhood", "alley")) + " FROM homes")
ORACLES["rare_labels_joined"] = f"SELECT p_partkey, CASE WHEN p_type IN {kept('p_type', 'part', 0.008)} THEN p_type ELSE 'Other' END AS p_type FROM part"
ONE_HOT = {
    "ms_zoning": ["C (all)", "RL", "RM"], "exter_qual": ["Gd", "TA"],
    "garage_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}
ORACLES["one_hot_wide"] = homes("SELECT pid, " + ", ".join(
    f"CASE WHEN {n} = '{v}' THEN 1.0E0 ELSE 0.0E0 END AS \"{n}_{v}\"" for n, vs in ONE_HOT.items() for v in vs) + " FROM homes")
ORACLES["one_hot_melt"] = homes("""SELECT pid, sale_price, 'neighborhood_' || neighborhood AS "group" FROM homes""")
SCALED = ["sale_price", "gr_liv_area", "overall_qual", "lot_area", "pool_area"]
ORACLES["standard_scale"] = homes(
    f", s AS (SELECT pid, {', '.join(SCALED)}, {split_of('pid')} AS split FROM homes), f AS (SELECT "
    + ", ".join(f"avg({n}) AS m_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS d_{n}" for n in SCALED) + " FROM s WHERE split = 'train') SELECT pid, "
    + ", ".join(f"{r(f'({n} - m_{n}) / d_{n}')} AS {n}" for n in SCALED) + ", split FROM s, f")

ROW_NUMBERS = ["overall_qual", "gr_liv_area", "total_bsmt_sf", "lot_frontage", "lot_area", "pool_area", "garage_cars"]
ROW_LABELS = ["ms_zoning", "exter_qual", "garage_type", "neighborhood"]
ORACLES["feature_rows"] = homes(
    f", s AS (SELECT pid, {', '.join(ROW_NUMBERS + ROW_LABELS)}, {split_of('pid')} AS split FROM homes), tr AS (SELECT * FROM s WHERE split = 'train'), l AS (SELECT pid, split, "
    + ", ".join([f"CASE WHEN {n} IN {kept(n, 'tr', 0.01)} THEN {n} ELSE 'Other' END AS {n}" for n in ROW_LABELS]
                + [f"CASE WHEN {n} IS NULL THEN NULL ELSE {logged(n, source='tr')} END AS {n}" for n in ROW_NUMBERS])
    + " FROM s), lt AS (SELECT * FROM l WHERE split = 'train'), fl AS (SELECT pid, split, "
    + ", ".join(ROW_LABELS + [f"coalesce({n}, (SELECT median({n}) FROM lt)) AS {n}" for n in ROW_NUMBERS]) + " FROM l), f AS (SELECT "
    + ", ".join(f"avg({n}) AS m_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS d_{n}" for n in ROW_NUMBERS) + " FROM fl WHERE split = 'train') SELECT pid, split, "
    + ", ".join(ROW_LABELS + [f"{r(f'({n} - m_{n}) / d_{n}')} AS {n}" for n in ROW_NUMBERS]) + " FROM fl, f")

# --- the whole preparation plan
_BODY = [n for n in ALL if n not in ("pid", "alley")]
_FILL = {n: f"coalesce(CAST({n} AS DOUBLE), (SELECT median({n}) FROM homes)) AS {n}" for n in GAPPED_NUMBERS}
_FILL |= {n: f"coalesce({n}, {mode(n)}) AS {n}" for n in ("garage_type", "exter_qual")}
_NUMERIC = [n for n in _BODY if n not in LABELS and n != "sale_price"]
_PREPARED_DOUBLES = DOUBLES | set(GAPPED_NUMBERS)
ORACLES["prepared_table"] = homes(
    ", fl AS (SELECT pid, " + ", ".join(_FILL.get(n, n) for n in _BODY) + " FROM homes), "
    "q AS (SELECT quantile_cont(sale_price, 0.25) AS q1, quantile_cont(sale_price, 0.75) AS q3 FROM fl), "
    "kp AS (SELECT fl.* REPLACE (ln(1 + sale_price) AS sale_price) FROM fl, q WHERE sale_price BETWEEN q1 - 1.5E0 * (q3 - q1) AND q3 + 1.5E0 * (q3 - q1)), "
    "e AS (SELECT quantile_cont(sale_price, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM kp), "
    "b AS (SELECT pid, (sale_price > q[2])::INT + (sale_price > q[3])::INT + (sale_price > q[4])::INT + (sale_price > q[5])::INT AS bin FROM kp, e), "
    "o AS (SELECT pid, row_number() OVER (PARTITION BY bin ORDER BY md5(pid || '#42'), pid) AS k, count(*) OVER (PARTITION BY bin) AS n FROM b), "
    "t AS (SELECT *, round(n * 0.15E0) AS nt FROM o), "
    "s AS (SELECT pid, CASE WHEN k <= nt THEN 'test' WHEN k <= nt + round((n - nt) * (0.15E0 / 0.85E0)) THEN 'val' ELSE 'train' END AS split FROM t) "
    'SELECT kp.pid AS "PID", '
    + ", ".join((r(logged(n, source="kp")) if n in _PREPARED_DOUBLES else n) + f' AS "{CANONICAL[n]}"' for n in _NUMERIC) + ", "
    + ", ".join(f"CASE WHEN {n} = '{v}' THEN 1.0E0 ELSE 0.0E0 END AS \"{CANONICAL[n]}_{v}\"" for n in ("garage_type", "exter_qual", "ms_zoning") for v in ONE_HOT[n]) + ", "
    + ", ".join(f"CASE WHEN neighborhood = 'NATION_{i}' THEN 1.0E0 ELSE 0.0E0 END AS \"Neighborhood_NATION_{i}\"" for i in range(25))
    + f", {r('sale_price')} AS \"SalePrice\", split FROM kp JOIN s ON kp.pid = s.pid")

# --- metrics and models
FORMULAS = f""", sp AS (SELECT *, {split_of('pid')} AS split FROM homes),
pr AS (SELECT 'by quality' AS model, split, sale_price AS y, 50000.0E0 + overall_qual * 25000.0E0 AS p FROM sp
 UNION ALL SELECT 'by quality and area', split, sale_price, 10000.0E0 + overall_qual * 14000.0E0 + gr_liv_area * 45.0E0 FROM sp)"""


def scores(y: str = "y", p: str = "p") -> str:
    return (f"{r(f'1 - sum(pow({y} - {p}, 2)) / (var_pop({y}) * count({y}))')} AS r2, {r(f'sqrt(avg(pow({y} - {p}, 2)))')} AS rmse, "
            f"{r(f'avg(abs({y} - {p}))')} AS mae, {r(f'100 * avg(abs({y} - {p}) / abs({y}))')} AS mape")


ORACLES["regression_metrics"] = homes(FORMULAS + f" SELECT model, split, {scores()} FROM pr GROUP BY 1, 2")
ORACLES["best_model"] = homes(FORMULAS + f", m AS (SELECT model, split, {scores()} FROM pr WHERE split = 'test' GROUP BY 1, 2) SELECT * FROM m ORDER BY rmse, model LIMIT 1")
ORACLES["model_meta"] = homes(
    FORMULAS + f", m AS (SELECT split AS dataset, {scores()} FROM pr WHERE model = 'by quality and area' GROUP BY 1) "
    + union([f"SELECT 'formula' AS model_type, '0.1.0' AS version, dataset, '{n}' AS metric, {n} AS value FROM m" for n in ("r2", "rmse", "mae", "mape")]))
ORACLES["train_and_save"] = homes(f""", sp AS (SELECT pid, neighborhood, gr_liv_area, sale_price AS y, {split_of('pid')} AS split FROM homes),
g AS (SELECT neighborhood, avg(y) AS p FROM sp WHERE split = 'train' GROUP BY 1),
l AS (SELECT regr_slope(y, gr_liv_area) AS a, regr_intercept(y, gr_liv_area) AS b FROM sp WHERE split = 'train'),
pr AS (SELECT 'groups' AS model, split, y, p FROM sp JOIN g USING (neighborhood) UNION ALL SELECT 'area', split, y, a * gr_liv_area + b FROM sp, l),
m AS (SELECT model, split AS dataset, {scores()} FROM pr GROUP BY 1, 2), best AS (SELECT model FROM m WHERE dataset = 'val' ORDER BY rmse, model LIMIT 1) """
    + union([f"SELECT model AS model_type, '0.1.0' AS version, dataset, '{n}' AS metric, {n} AS value FROM m JOIN best USING (model) WHERE dataset <> 'train'" for n in ("r2", "rmse", "mae", "mape")]))
ORACLES["ols_single"] = homes(f"""SELECT {r('regr_slope(sale_price, gr_liv_area)')} AS slope, {r('regr_intercept(sale_price, gr_liv_area)', 4)} AS intercept,
 {r('regr_r2(sale_price, gr_liv_area)')} AS r2 FROM homes""")
ORACLES["ols_pair"] = homes(f""", m AS (SELECT avg(sale_price) AS y, avg(overall_qual) AS a, avg(gr_liv_area) AS b, var_pop(overall_qual) AS aa, var_pop(gr_liv_area) AS bb,
 covar_pop(overall_qual, gr_liv_area) AS ab, covar_pop(overall_qual, sale_price) AS ay, covar_pop(gr_liv_area, sale_price) AS bye FROM homes)
 SELECT pid, {r('y + (ay * bb - bye * ab) / (aa * bb - ab * ab) * (overall_qual - a) + (bye * aa - ay * ab) / (aa * bb - ab * ab) * (gr_liv_area - b)', 2)} AS prediction FROM homes, m""")
GROUP_MEANS = homes(f"SELECT neighborhood, {r('avg(sale_price)', 2)} AS prediction FROM homes GROUP BY 1")
ORACLES["tree_group_means"] = ORACLES["gbt_group_means"] = ORACLES["registry_round_trip"] = GROUP_MEANS


def adaboost_rounds(n: int) -> str:
    """AdaBoost.R2 whose trees predict the weighted mean of each group: (g, p, a) of round i in r1 .. rn, a its weight, 0 after the end."""
    steps = ", w1 AS (SELECT pid, neighborhood AS g, sale_price AS y, 1E0 AS w, true AS alive FROM homes)"
    for i in range(1, n + 1):
        first = "WHEN alive THEN 1E0 " if i == 1 else ""
        steps += f""",
m{i} AS MATERIALIZED (SELECT *, sum(w * y) OVER (PARTITION BY g) / sum(w) OVER (PARTITION BY g) AS p FROM w{i}),
s{i} AS MATERIALIZED (SELECT max(abs(y - p)) AS worst, sum(w * abs(y - p)) / sum(w) / max(abs(y - p)) AS loss, count(*) / sum(w) AS unit FROM m{i}),
r{i} AS (SELECT g, any_value(p) AS p, any_value(CASE WHEN alive AND loss < 0.5 THEN ln((1 - loss) / loss) {first}ELSE 0E0 END) AS a FROM m{i}, s{i} GROUP BY g),
w{i + 1} AS MATERIALIZED (SELECT pid, g, y, w * pow(loss / (1 - loss), 1 - abs(y - p) / worst) * unit AS w, alive AND loss < 0.5 AS alive FROM m{i}, s{i})"""
    return steps


ORACLES["adaboost_groups"] = homes(adaboost_rounds(10) + f""", t AS ({' UNION ALL '.join(f'SELECT * FROM r{i}' for i in range(1, 11))}),
o AS (SELECT g, p, sum(a) OVER (PARTITION BY g ORDER BY p, a ROWS UNBOUNDED PRECEDING) AS run, sum(a) OVER (PARTITION BY g) AS whole FROM t WHERE a > 0)
SELECT g AS neighborhood, {r('min(p)', 2)} AS prediction FROM o WHERE run >= whole / 2 * (1 - 1E-12) GROUP BY 1""")
FOLDED = f""", f AS (SELECT pid, neighborhood AS g, sale_price AS y, {FOLD.format(key='pid')} AS fold FROM homes),
k AS (SELECT g, fold, sum(y) AS s, count(*) AS n FROM f GROUP BY 1, 2), w AS (SELECT g, sum(s) AS s, sum(n) AS n FROM k GROUP BY 1),
pr AS (SELECT pid, fold, y, (w.s - k.s) / (w.n - k.n) AS p FROM f JOIN k USING (g, fold) JOIN w USING (g))"""
ORACLES["fold_predictions"] = homes(FOLDED + f" SELECT pid, {r('p', 2)} AS prediction FROM pr")
ORACLES["fold_metrics"] = homes(FOLDED + f" SELECT {scores()} FROM pr")
ORACLES["fold_scores"] = homes(FOLDED + f" SELECT fold, {scores()} FROM pr GROUP BY 1")
ORACLES["counterfactual"] = homes(union([
    f"""SELECT {v}E0 AS value, {r(f'regr_intercept(sale_price, gr_liv_area) + {v}E0 * regr_slope(sale_price, gr_liv_area)', 2)} AS mean_prediction FROM homes"""
    for v in ("800.0", "3500.0")]))

# --- scoring
VALID = ("overall_qual BETWEEN 1 AND 10 AND gr_liv_area > 0 AND year_built BETWEEN 1800 AND 2025 AND coalesce(year_remod_add BETWEEN 1800 AND 2025, true)"
         " AND coalesce(yr_sold BETWEEN 2006 AND 2025, true) AND coalesce(garage_cars BETWEEN 0 AND 5, true) AND coalesce(garage_area >= 0, true)"
         " AND coalesce(total_bsmt_sf >= 0, true)")
GIVEN = {
    "Overall Qual": "overall_qual", "Gr Liv Area": "gr_liv_area", "Year Built": "year_built", "Year Remod/Add": "coalesce(year_remod_add, year_built)",
    "Yr Sold": "yr_sold", "Garage Cars": "coalesce(garage_cars, 1)", "Garage Area": "coalesce(garage_area, 0)", "1st Flr SF": "gr_liv_area",
    "Total Bsmt SF": "coalesce(total_bsmt_sf, 0)", "Exter Qual": "coalesce(exter_qual, 'TA')", "Neighborhood": "neighborhood",
}


def _default(value) -> str:
    return f"'{value}'" if isinstance(value, str) else f"{value}E0" if isinstance(value, float) else str(value)


ORACLES["request_defaults"] = homes("SELECT pid, " + ", ".join(
    f'{GIVEN.get(name) or _default(default)} AS "{name}"' for _, name, _, default, _, _ in fixed.REQUEST_FIELDS) + f" FROM homes WHERE {VALID}")
REQUEST_RULES = [
    ("OverallQual", ">= 1", "overall_qual < 1", "overall_qual"), ("OverallQual", "<= 10", "overall_qual > 10", "overall_qual"),
    ("GrLivArea", "> 0", "gr_liv_area <= 0", "gr_liv_area"), ("YearBuilt", "<= 2025", "year_built > 2025", "year_built"),
    ("YearRemodAdd", "<= 2025", "year_remod_add > 2025", "year_remod_add"), ("GarageCars", "<= 5", "garage_cars > 5", "garage_cars"),
]
ORACLES["request_quarantine"] = homes(union([
    f"""SELECT pid, '{a}' AS "column", '{b}' AS "check", CAST({v} AS VARCHAR) AS value FROM homes WHERE {x}""" for a, b, x, v in REQUEST_RULES]))
ORACLES["score_batch"] = ORACLES["score_stream"] = homes(
    f""", m AS (SELECT neighborhood, exp(avg(ln(1 + sale_price))) - 1 AS p FROM homes GROUP BY 1)
 SELECT pid, {r('p', 2)} AS predicted_price, {r('p * (1 - 0.09E0)', 2)} AS lower_bound, {r('p * (1 + 0.09E0)', 2)} AS upper_bound, '0.1.0' AS model_version
 FROM homes JOIN m USING (neighborhood) WHERE {VALID}""")

# --- lines with bad cells
_LINES = """WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE '' END || o_orderkey AS id,
 CASE WHEN o_orderkey % 13 = 0 THEN 'n.b.' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price, o_orderpriority AS priority FROM orders)"""
ORACLES["csv_good_rows"] = _LINES + f""" SELECT CAST(id AS BIGINT) AS id, {r('CAST(price AS DOUBLE)', 2)} AS price, priority FROM o
 WHERE k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0 AND k % 17 <> 0"""
ORACLES["csv_quarantine"] = _LINES + """ SELECT id || ',' || price || CASE WHEN k % 11 = 0 THEN '' ELSE ',' || priority || ',more' END AS record, NULL AS "column",
 'as many cells as the header' AS "check", NULL AS value FROM o WHERE k % 11 = 0 OR k % 7 = 0
 UNION ALL SELECT id || ',' || price || ',' || priority, 'id', 'is bigint', id FROM o WHERE k % 11 <> 0 AND k % 7 <> 0 AND k % 17 = 0
 UNION ALL SELECT id || ',' || price || ',' || priority, 'price', 'is double', price FROM o WHERE k % 11 <> 0 AND k % 7 <> 0 AND k % 13 = 0"""
ORACLES["label_dictionary"] = """WITH l AS (SELECT 'c_name' AS "column", c_name AS value FROM customer UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer)
SELECT "column", value, count(*) AS n, row_number() OVER (ORDER BY "column", value) - 1 AS number FROM l WHERE value IS NOT NULL GROUP BY 1, 2"""
ORACLES["split_shared_keys"] = """WITH g AS (SELECT l_returnflag, count(*) AS n, CAST(round(count(*) * 0.15E0) AS BIGINT) AS test FROM lineitem GROUP BY 1),
s AS (SELECT *, CAST(round((n - test) * (0.15E0 / 0.85E0)) AS BIGINT) AS val FROM g)
SELECT l_returnflag, 'test' AS split, test AS n FROM s UNION ALL SELECT l_returnflag, 'val', val FROM s UNION ALL SELECT l_returnflag, 'train', n - test - val FROM s"""
ORACLES["score_stream_stamped"] = homes(f""", i AS (SELECT pid, md5('7=nightly|' || length(CAST(pid AS VARCHAR)) || '=' || pid) AS h FROM homes WHERE {VALID})
 SELECT pid, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS prediction_id, true AS stamped FROM i""")
ORACLES["prepare_from_csv"] = f'SELECT * EXCLUDE ("PID") FROM ({ORACLES["prepared_table"]})'
