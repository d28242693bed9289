"""The registered queries once more, as SQL over the same tables, to check results against.

Money is counted in whole cents and ratios are taken on whole numbers, so that half-up rounding
does not depend on how an engine divides decimals.
"""

from __future__ import annotations

from tillstar.schemas import CHEESE_WORDS, MEAT_WORDS


def _money(cents: str) -> str:
    return f"CAST(CAST(({cents}) AS DECIMAL(28,0)) * 0.01::DECIMAL(3,2) AS DECIMAL(18,2))"


def _ratio(num: str, den: str, digits: int) -> str:
    """num/den of whole numbers, half up."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    whole = f"(sign({n}) * ((2 * abs({n}) * {10**digits} + {d}) // (2 * {d})))"
    step = {0: "1::DECIMAL(1,0)", 1: "0.1::DECIMAL(2,1)", 2: "0.01::DECIMAL(3,2)",
            3: "0.001::DECIMAL(4,3)", 5: "0.00001::DECIMAL(6,5)"}[digits]
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(CAST({whole} AS DECIMAL(28,0)) * {step} "
        f"AS DECIMAL(18,{digits})) END"
    )


def _pct(num: str, den: str, digits: int = 2) -> str:
    return _ratio(f"100 * CAST(({num}) AS HUGEINT)", den, digits)


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


_ORDER = (
    "l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_linenumber"
)
_SIZE = (
    "CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 20 THEN 'M' WHEN p_size <= 30 THEN 'L' "
    "WHEN p_size <= 40 THEN 'XL' ELSE 'XXL' END"
)
_SIZE_ORDER = "CASE sz WHEN 'S' THEN 1 WHEN 'M' THEN 2 WHEN 'L' THEN 3 WHEN 'XL' THEN 4 ELSE 5 END"
_SIZE_LABEL = (
    "CASE sz WHEN 'S' THEN 'Small' WHEN 'M' THEN 'Medium' WHEN 'L' THEN 'Large' "
    "WHEN 'XL' THEN 'Extra Large' ELSE 'Double Extra Large' END"
)
_EXT = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_QTY = "CAST(l_quantity AS BIGINT)"
_UNIT = f"((2 * {_EXT} + {_QTY}) // (2 * {_QTY}))"
_NAME_ID = f"lower(p_brand) || '_' || p_partkey || '_' || lower({_SIZE})"

_DEDUP = f"""
s8 AS (SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) = 1),
s9 AS (SELECT * FROM s8
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_quantity ORDER BY {_ORDER}) = 1)
"""

_RETAIL = f"""{_DEDUP},
f AS (SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
    CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS TIMESTAMP) AS ts, 0 AS hr,
    {_NAME_ID} AS name_id, lower(p_brand) AS code, p_brand AS short,
    'The ' || p_brand || ' Item' AS name,
    upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS cat, {_SIZE} AS sz,
    replace(p_name, ' ', ', ') AS recipe, CAST(l_quantity AS INTEGER) AS qty,
    {_UNIT} AS uc, {_UNIT} * {_QTY} AS tc, {_EXT} AS src
  FROM s9 JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_PLANTED = _RETAIL.replace(
    "replace(p_name, ' ', ', ')",
    "replace(p_name, ' ', ', ') || CASE WHEN p_partkey % 5 = 0 THEN ', hAM' ELSE '' END "
    "|| CASE WHEN p_partkey % 7 = 0 THEN ',CHEESE ' ELSE '' END",
)

_KEY = "CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS BIGINT)"
_EVENTS = f"""e AS (SELECT event_id AS order_item_id, user_id * 100000000 + {_KEY} AS order_id,
    CAST(ts AS DATE) AS d, CAST(ts AS TIMESTAMP) AS ts, hour(ts) AS hr, event_type || '_m' AS name_id,
    event_type AS code, upper(left(event_type, 1)) || substr(event_type, 2) AS short,
    'The ' || upper(left(event_type, 1)) || substr(event_type, 2) || ' Item' AS name,
    upper(left(event_type, 1)) || substr(event_type, 2) AS cat, 'M' AS sz, event_type AS recipe,
    1 AS qty, CAST(round(value * 100) AS BIGINT) AS uc, CAST(round(value * 100) AS BIGINT) AS tc,
    CAST(round(value * 100) AS BIGINT) AS src
  FROM events),
f AS (SELECT * FROM e
  QUALIFY row_number() OVER (PARTITION BY order_id, code, ts ORDER BY order_item_id) = 1)"""

_PART = (
    "CASE WHEN hr <= 10 THEN 'Pre-Opening' WHEN hr <= 13 THEN 'Lunch' WHEN hr <= 16 THEN "
    "'Afternoon' WHEN hr <= 20 THEN 'Dinner' ELSE 'Late Night' END"
)
_LABEL = "printf('%02d:00', hr)"

_ITEMS = f""",
attr AS (SELECT name_id, any_value(code) AS code, any_value(name) AS name, any_value(short) AS short,
    any_value(cat) AS cat, any_value(sz) AS sz, any_value(recipe) AS recipe,
    CAST(floor(median(uc) + 0.5) AS BIGINT) AS mid, min(uc) AS lo, max(uc) AS hi
  FROM f GROUP BY name_id),
item AS (SELECT row_number() OVER (ORDER BY code, {_SIZE_ORDER}, name_id) AS item_key,
    {_SIZE_ORDER} AS size_sort, {_SIZE_LABEL} AS size_label, * FROM attr),
link AS (SELECT DISTINCT item_key, upper(left(w, 1)) || lower(substr(w, 2)) AS ingredient
  FROM (SELECT item_key, trim(unnest(string_split(recipe, ','))) AS w FROM item) WHERE w <> ''),
ingr AS (SELECT row_number() OVER (ORDER BY ingredient) AS ingredient_key, ingredient,
    regexp_matches(lower(ingredient), '{'|'.join(CHEESE_WORDS)}') AS is_cheese
  FROM (SELECT DISTINCT ingredient FROM link))"""

_CAL = """,
cal AS (SELECT CAST(d AS DATE) AS d FROM (
  SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
  FROM (SELECT min(d) AS lo, max(d) AS hi FROM f)))"""

_DAYS = """,
day AS (SELECT d, sum(tc) AS rev, sum(qty) AS units, count(DISTINCT order_id) AS orders
  FROM f GROUP BY d)"""

_MONTHS = """,
m AS (SELECT strftime(d, '%Y-%m') AS ym, min(d) AS month_start, strftime(min(d), '%b') AS ms,
    CAST(date_trunc('month', min(d)) AS DATE) AS m1,
    sum(tc) AS rev, sum(qty) AS units, count(DISTINCT order_id) AS orders
  FROM f GROUP BY strftime(d, '%Y-%m'))"""

_PRODUCTS = f""",
tot AS (SELECT sum(tc) AS t FROM f),
p AS (SELECT code, min(short) AS short, min(name) AS name, min(cat) AS cat, sum(tc) AS rev,
    sum(qty) AS units, count(DISTINCT order_id) AS orders, sum(uc) AS uc_sum, count(*) AS n
  FROM f GROUP BY code),
pr AS (SELECT *, rank() OVER (ORDER BY rev DESC) AS rr, rank() OVER (ORDER BY units DESC) AS vr,
    dense_rank() OVER (ORDER BY rev DESC) AS dr,
    row_number() OVER (ORDER BY rev DESC, code) AS rn,
    sum(rev) OVER (ORDER BY rev DESC, code ROWS UNBOUNDED PRECEDING) AS run,
    sum(rev) OVER (ORDER BY rev DESC) AS run_ties, (SELECT t FROM tot) AS t FROM p),
pp AS (SELECT *, {_pct('rev', 't')} AS pct, {_pct('run', 't')} AS cum FROM pr),
perf AS (SELECT *, CASE WHEN cum <= 80 THEN 'A' WHEN cum <= 95 THEN 'B' ELSE 'C' END AS abc FROM pp)"""

_BASKETS = """,
b AS (SELECT order_id, sum(qty) AS items, sum(tc) AS val, count(*) AS lines FROM f GROUP BY order_id)"""

_PAIRS = f""",
op AS (SELECT DISTINCT order_id, code FROM f),
nn AS (SELECT count(DISTINCT order_id) AS n FROM op),
sg AS (SELECT code, count(*) AS cnt FROM op GROUP BY code),
nm AS (SELECT code, min(short) AS nm FROM f GROUP BY code),
pc AS (SELECT x.code AS a, y.code AS b, count(*) AS k FROM op x JOIN op y
  ON x.order_id = y.order_id AND x.code < y.code GROUP BY 1, 2 HAVING count(*) >= 30),
aff AS (SELECT na.nm AS product_a, nb.nm AS product_b, k AS orders_together,
    {_pct('k', 'n', 3)} AS support_pct, {_pct('k', 'sa.cnt')} AS confidence_a_to_b_pct,
    {_pct('k', 'sb.cnt')} AS confidence_b_to_a_pct,
    {_ratio('k * n', 'sa.cnt * sb.cnt', 3)} AS lift
  FROM pc JOIN sg sa ON sa.code = a JOIN sg sb ON sb.code = b JOIN nm na ON na.code = a
  JOIN nm nb ON nb.code = b CROSS JOIN nn)"""

_EXPOSURE = f""",
ex AS (SELECT ingredient AS ingredient_name, is_cheese, count(DISTINCT item.code) AS products_using,
    {_big('sum(qty)')} AS items_sold, sum(tc) AS rev
  FROM f JOIN item USING (name_id) JOIN link USING (item_key) JOIN ingr USING (ingredient)
  GROUP BY 1, 2)"""

_HOURS = f""",
h AS (SELECT hr, sum(tc) AS rev, sum(qty) AS units, count(DISTINCT order_id) AS orders
  FROM f GROUP BY hr)"""


def _retail(extra: str, select: str) -> str:
    return f"WITH {_RETAIL}{extra}\n{select}"


def _counter(extra: str, select: str) -> str:
    return f"WITH {_EVENTS}{extra}\n{select}"


# The raw text lines and their verdicts.
_K = "l_orderkey"
_TEXT = f"""
raw AS (SELECT CASE WHEN {_K} % 71 = 6 THEN 'x' ELSE CAST({_K} * 10 + l_linenumber AS VARCHAR) END AS item_id,
    CAST({_K} AS VARCHAR) AS order_id,
    CASE WHEN {_K} % 73 = 5 THEN ' ' ELSE upper({_NAME_ID}) END AS item_name_id,
    CASE WHEN ({_K} + l_suppkey) % 89 = 2 THEN '0' ELSE CAST({_QTY} AS VARCHAR) END AS quantity,
    CASE WHEN {_K} % 97 = 1 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%d-%m-%Y') END AS order_date,
    CASE WHEN {_K} % 67 = 7 THEN '25:00:00' ELSE printf('%02d:%02d:00', {_K} % 24, {_K} % 60) END AS order_time,
    CASE WHEN ({_K} + l_suppkey) % 83 = 3 THEN 'n/a' ELSE CAST({_money(_UNIT)} AS VARCHAR) END AS unit_price,
    CAST({_money(_EXT)} AS VARCHAR) AS total_price,
    CASE WHEN {_K} % 79 = 4 THEN 'Q' ELSE lower({_SIZE}) END AS item_size,
    p_type AS item_category, replace(p_name, ' ', ', ') AS item_ingredients,
    'The ' || p_brand || ' Item' AS item_name, {_K} AS ok, l_linenumber AS ln,
    CAST(o_orderdate AS DATE) AS d, {_QTY} AS q, {_UNIT} AS uc, {_EXT} AS src,
    row_number() OVER (ORDER BY {_K}, {_ORDER}) AS pos
  FROM lineitem JOIN orders ON {_K} = o_orderkey JOIN part ON l_partkey = p_partkey)"""
_RAW_COLUMNS = (
    "item_id, order_id, item_name_id, quantity, order_date, order_time, unit_price, total_price, "
    "item_size, item_category, item_ingredients, item_name"
)
_JUDGED = f"""{_TEXT},
j1 AS (SELECT *, CASE WHEN item_id = 'x' THEN 'unparseable identifier'
    WHEN order_date LIKE '%/%' THEN 'unparseable order_date (expected DD-MM-YYYY)'
    WHEN order_time = '25:00:00' THEN 'unparseable order_time (expected HH:MM:SS)'
    WHEN quantity = '0' THEN 'quantity must be a positive integer'
    WHEN unit_price = 'n/a' THEN 'unit_price must be positive'
    WHEN item_size = 'Q' THEN 'unknown item_size'
    WHEN item_name_id = ' ' THEN 'missing product key' END AS r1 FROM raw),
j2 AS (SELECT *, CASE WHEN r1 IS NULL AND row_number() OVER (
    PARTITION BY r1 IS NULL, item_id ORDER BY pos) > 1 THEN 'duplicate item_id' ELSE r1 END AS r2
  FROM j1),
j AS (SELECT *, CASE WHEN r2 IS NULL AND row_number() OVER (
    PARTITION BY r2 IS NULL, order_id, item_name_id, order_time, quantity ORDER BY pos) > 1
    THEN 'duplicate line item within order' ELSE r2 END AS reject_reason FROM j2)"""


def _raw(select: str) -> str:
    return f"WITH {_TEXT}\n{select}"


def _judged(select: str, more: str = "") -> str:
    return f"WITH {_JUDGED}{',' if more else ''}{more}\n{select}"


def _calendar_row(d: str) -> str:
    return f"""CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d} AS full_date,
    CAST(year({d}) AS INTEGER) AS year, CAST(quarter({d}) AS INTEGER) AS quarter,
    'Q' || quarter({d}) || ' ' || year({d}) AS quarter_name,
    CAST(month({d}) AS INTEGER) AS month_number, strftime({d}, '%B') AS month_name,
    strftime({d}, '%b') AS month_short, strftime({d}, '%Y-%m') AS year_month,
    CAST(week({d}) AS INTEGER) AS iso_week, CAST(day({d}) AS INTEGER) AS day_of_month,
    CAST(isodow({d}) AS INTEGER) AS day_of_week, strftime({d}, '%A') AS day_name,
    strftime({d}, '%a') AS day_short, isodow({d}) >= 6 AS is_weekend,
    CAST(dayofyear({d}) AS INTEGER) AS day_of_year"""


_TIME_ROW = f"""CAST(hr AS INTEGER) AS time_key, CAST(hr AS INTEGER) AS hour_24,
    {_LABEL} AS hour_label,
    (CASE WHEN hr % 12 = 0 THEN 12 ELSE hr % 12 END) || CASE WHEN hr < 12 THEN ' AM' ELSE ' PM' END AS hour_12,
    {_PART} AS day_part, {_PART} IN ('Lunch', 'Dinner') AS is_peak_window"""

_MEAT = "|".join(MEAT_WORDS)

_FACT = f"""SELECT order_item_id, order_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(hr AS INTEGER) AS time_key, item_key, ts AS order_ts, qty AS quantity,
    CAST({_money('uc')} AS DECIMAL(10,2)) AS unit_price, {_money('tc')} AS total_price,
    {_money('src')} AS total_price_source, abs(tc - src) > 1 AS price_variance_flag,
    count(*) OVER o AS order_line_count, {_big('sum(qty) OVER o')} AS order_item_count,
    {_money('sum(tc) OVER o')} AS order_total_value
  FROM f JOIN item USING (name_id) WINDOW o AS (PARTITION BY order_id)"""

_PERF = f"""SELECT code AS product_code, short AS item_short_name, name AS item_name,
    cat AS item_category, TRUE AS is_vegetarian, {_money('rev')} AS revenue,
    {_big('units')} AS items_sold, orders, {_ratio('uc_sum', 'n * 100', 2)} AS avg_unit_price,
    rr AS revenue_rank, vr AS volume_rank, pct AS pct_of_revenue,
    cum AS cumulative_pct_of_revenue, abc AS abc_class FROM perf"""

_KPI = f"""SELECT {_money('sum(tc)')} AS total_revenue, {_big('sum(qty)')} AS total_items_sold,
    count(DISTINCT order_id) AS total_orders, count(*) AS total_line_items,
    count(DISTINCT d) AS trading_days,
    {_ratio('sum(tc)', 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value,
    {_ratio('sum(qty)', 'count(DISTINCT order_id)', 2)} AS avg_items_per_order,
    {_ratio('sum(tc)', 'count(DISTINCT d) * 100', 2)} AS avg_revenue_per_day,
    {_ratio('count(DISTINCT order_id)', 'count(DISTINCT d)', 1)} AS avg_orders_per_day FROM f"""

_DAILY = f"""SELECT d AS full_date, strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend,
    strftime(d, '%Y-%m') AS year_month, {_money('rev')} AS revenue, {_big('units')} AS items_sold,
    orders, {_ratio('rev', 'orders * 100', 2)} AS avg_order_value,
    {_ratio('sum(rev) OVER w', '(count(*) OVER w) * 100', 2)} AS revenue_7d_moving_avg
  FROM day WINDOW w AS (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

_MONTHLY = f"""SELECT ym AS year_month, month_start, ms AS month_short, {_money('rev')} AS revenue,
    {_big('units')} AS items_sold, orders, {_ratio('rev', 'orders * 100', 2)} AS avg_order_value,
    {_money('lag(rev) OVER w')} AS prev_month_revenue,
    {_pct('rev - lag(rev) OVER w', 'lag(rev) OVER w')} AS mom_growth_pct,
    {_pct('rev', 'sum(rev) OVER ()')} AS pct_of_year_revenue
  FROM m WINDOW w AS (ORDER BY month_start)"""

_CATEGORY = f"""SELECT cat AS item_category, {_money('sum(tc)')} AS revenue,
    {_big('sum(qty)')} AS items_sold, count(DISTINCT order_id) AS orders,
    count(DISTINCT code) AS products_offered,
    {_pct('sum(tc)', '(SELECT sum(tc) FROM f)')} AS pct_of_revenue,
    {_ratio('sum(uc)', 'count(*) * 100', 2)} AS avg_unit_price FROM f GROUP BY cat"""

_BY_SIZE = f"""SELECT sz AS item_size, {_SIZE_LABEL} AS size_label, {_SIZE_ORDER} AS size_sort_order,
    {_money('sum(tc)')} AS revenue, {_big('sum(qty)')} AS items_sold,
    {_pct('sum(tc)', '(SELECT sum(tc) FROM f)')} AS pct_of_revenue,
    {_ratio('sum(uc)', 'count(*) * 100', 2)} AS avg_unit_price FROM f GROUP BY sz"""

_HOURLY = f"""SELECT CAST(hr AS INTEGER) AS hour_24, {_LABEL} AS hour_label, {_PART} AS day_part,
    {_PART} IN ('Lunch', 'Dinner') AS is_peak_window, {_money('rev')} AS revenue,
    {_big('units')} AS items_sold, orders,
    {_ratio('orders', '(SELECT count(DISTINCT d) FROM f)', 1)} AS avg_orders_per_day FROM h"""

_BASKET = f"""SELECT {_big('items')} AS items_in_order, count(*) AS orders,
    {_pct('count(*)', '(SELECT count(*) FROM b)')} AS pct_of_orders, {_money('sum(val)')} AS revenue,
    {_ratio('sum(val)', 'count(*) * 100', 2)} AS avg_order_value FROM b GROUP BY items"""

_EXP = f"""SELECT ingredient_name, is_cheese, products_using, items_sold,
    {_money('rev')} AS attributed_revenue, {_pct('rev', '(SELECT sum(tc) FROM f)')} AS pct_of_revenue
  FROM ex"""


def _measures(by: str) -> str:
    o, d = "count(DISTINCT order_id)", "count(DISTINCT d)"
    return f"""{by}, {_money('sum(tc)')} AS revenue, {_big('sum(qty)')} AS items_sold,
    {o} AS orders, {d} AS trading_days, {_ratio('sum(tc)', o + ' * 100', 2)} AS avg_order_value,
    {_ratio('sum(qty)', o, 2)} AS items_per_order,
    {_ratio('sum(tc)', 'sum(qty) * 100', 2)} AS avg_unit_price,
    {_ratio('sum(tc)', d + ' * 100', 2)} AS revenue_per_day, {_ratio(o, d, 2)} AS orders_per_day"""


def _count_of(table: str, name: str) -> str:
    return f"SELECT '{name}' AS \"table\", count(*) AS n FROM {table}"


_TABLE_COUNTS = " UNION ALL ".join(
    [
        _count_of("cal", "dim_date"),
        _count_of("range(24)", "dim_time"),
        _count_of("item", "dim_item"),
        _count_of("ingr", "dim_ingredient"),
        _count_of("link", "bridge_item_ingredient"),
        _count_of("f", "fact_order_items"),
    ]
)

_DOMAIN = "('Economy', 'Medium', 'Promo', 'Small', 'Standard')"


def _checks() -> str:
    """(check, severity, bad_count, text) of the gate."""
    rows = [
        ("fact primary key is unique", "error",
         "SELECT count(*) - count(DISTINCT order_item_id) FROM f", "repeated line keys"),
        ("no null foreign keys in fact", "error",
         "SELECT count(*) FROM f WHERE order_item_id IS NULL OR order_id IS NULL OR d IS NULL OR hr IS NULL OR name_id IS NULL",
         "keys left empty in order lines"),
        ("fact -> dim_item referential integrity", "error",
         "SELECT count(DISTINCT name_id) FROM f WHERE name_id NOT IN (SELECT name_id FROM item)",
         "item keys without a item"),
        ("fact -> dim_date referential integrity", "error",
         "SELECT count(DISTINCT d) FROM f WHERE d NOT IN (SELECT d FROM cal)",
         "days that the calendar lacks"),
        ("fact -> dim_time referential integrity", "error",
         "SELECT count(DISTINCT hr) FROM f WHERE hr NOT BETWEEN 0 AND 23",
         "hours that the day lacks"),
        ("dim_date has no gaps", "error",
         "SELECT count(*) FROM (SELECT d - lag(d) OVER (ORDER BY d) AS step FROM cal) WHERE step <> 1",
         "breaks between calendar days"),
        ("all measures are positive", "error",
         "SELECT count(*) FROM f WHERE qty <= 0 OR uc <= 0 OR tc <= 0",
         "lines whose quantity, price or amount is not above zero"),
        ("revenue = unit_price x quantity", "error",
         "SELECT count(*) FROM f WHERE abs(uc * qty - tc) > 1",
         "lines whose amount is not price times quantity"),
        ("order totals reconcile to line items", "error",
         "SELECT count(*) FROM (SELECT order_id, sum(tc) AS a, min(v) AS v FROM (SELECT order_id, tc, "
         "sum(tc) OVER (PARTITION BY order_id) AS v FROM f) GROUP BY order_id) WHERE abs(a - v) > 1",
         "orders whose stored total is not that of their lines"),
        ("dim_item natural key is unique", "error",
         "SELECT count(*) - count(DISTINCT name_id) FROM item",
         "repeated item_name_id"),
        ("ingredient bridge has no orphans", "error",
         "SELECT count(*) FROM link WHERE item_key NOT IN (SELECT item_key FROM item) OR ingredient NOT IN (SELECT ingredient FROM ingr)",
         "recipe links to nowhere"),
        ("item_category domain is closed", "warning",
         f"SELECT count(DISTINCT cat) FROM item WHERE cat NOT IN {_DOMAIN}",
         f"SELECT 'outside the domain: ' || string_agg(cat, ', ' ORDER BY cat) "
         f"FROM (SELECT DISTINCT cat FROM item WHERE cat NOT IN {_DOMAIN})"),
        ("unit price is stable per product", "warning",
         "SELECT count(*) FROM item WHERE hi - lo > 1",
         "products with more than one price"),
        ("rejection rate below 1%", "warning", "SELECT 0", "raw rows turned away, one in a hundred or more"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", '{s}' AS severity, {_big(f'({q})')} AS bad_count, "
        + (f"({t})" if t.startswith("SELECT") else f"'{t}'") + " AS text"
        for c, s, q, t in rows
    )


_STATUS = (
    "CASE WHEN bad_count = 0 THEN 'PASS' WHEN severity = 'error' THEN 'FAIL' ELSE 'WARN' END"
)


def _constraints() -> str:
    def uniq(table: str, shown: str, cols: str, real: str) -> tuple:
        return (table, "unique", shown, f"SELECT count(*) - count(DISTINCT ({cols})) FROM {real}")

    def nulls(table: str, cols: list[str], real: str) -> tuple:
        test = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)
        return (table, "not null", "all required", f"SELECT coalesce(sum({test}), 0) FROM {real}")

    rows = [
        uniq("dim_date", "date_key", "strftime(d, '%Y%m%d')", "cal"),
        uniq("dim_date", "full_date", "d", "cal"),
        nulls("dim_date", ["d"], "cal"),
        uniq("dim_time", "time_key", "range", "range(24)"),
        nulls("dim_time", ["range"], "range(24)"),
        uniq("dim_item", "item_key", "item_key", "item"),
        uniq("dim_item", "item_name_id", "name_id", "item"),
        nulls("dim_item", ["item_key", "name_id", "code", "name", "cat", "sz", "mid", "recipe"], "item"),
        ("dim_item", "positive", "unit_price", "SELECT count(*) FROM item WHERE mid <= 0"),
        uniq("dim_ingredient", "ingredient_key", "ingredient_key", "ingr"),
        uniq("dim_ingredient", "ingredient_name", "ingredient", "ingr"),
        nulls("dim_ingredient", ["ingredient_key", "ingredient"], "ingr"),
        ("bridge_item_ingredient", "unique", "item_key,ingredient_key",
         "SELECT (SELECT count(*) FROM link) - (SELECT count(*) FROM (SELECT DISTINCT item_key, ingredient FROM link))"),
        nulls("bridge_item_ingredient", ["item_key", "ingredient"], "link"),
        ("bridge_item_ingredient", "foreign key", "item_key",
         "SELECT count(DISTINCT item_key) FROM link WHERE item_key NOT IN (SELECT item_key FROM item)"),
        ("bridge_item_ingredient", "foreign key", "ingredient_key",
         "SELECT count(DISTINCT ingredient) FROM link WHERE ingredient NOT IN (SELECT ingredient FROM ingr)"),
        uniq("fact_order_items", "order_item_id", "order_item_id", "f"),
        nulls("fact_order_items", ["order_item_id", "order_id", "d", "hr", "name_id", "ts", "qty", "uc", "tc"], "f"),
        ("fact_order_items", "positive", "quantity,unit_price,total_price",
         "SELECT count(*) FROM f WHERE qty <= 0 OR uc <= 0 OR tc <= 0"),
        ("fact_order_items", "foreign key", "date_key",
         "SELECT count(DISTINCT d) FROM f WHERE d NOT IN (SELECT d FROM cal)"),
        ("fact_order_items", "foreign key", "time_key",
         "SELECT count(DISTINCT hr) FROM f WHERE hr NOT BETWEEN 0 AND 23"),
        ("fact_order_items", "foreign key", "item_key",
         "SELECT count(DISTINCT name_id) FROM f WHERE name_id NOT IN (SELECT name_id FROM item)"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{k}' AS \"constraint\", '{c}' AS columns, {_big(f'({q})')} AS bad_count"
        for t, k, c, q in rows
    )


def _numeric(name: str, cents: str) -> str:
    """One profile row; ``cents`` is the measure times 100 or NULL."""
    def third(q: float) -> str:
        return f"CAST(round(quantile_cont({cents}, {q}) / 100, 3) AS DECIMAL(18,3))"

    return f"""SELECT '{name}' AS measure, count({cents}) AS "count",
    {_ratio(f'sum({cents})', f'count({cents}) * 100', 5)} AS mean,
    CAST(round(stddev_samp({cents} / 100), 4) AS DECIMAL(18,4)) AS std,
    {_money(f'min({cents})')} AS "min", {third(0.25)} AS p25, {third(0.5)} AS p50,
    {third(0.75)} AS p75, {_money(f'max({cents})')} AS "max",
    count(*) - count({cents}) AS non_numeric, count(*) FILTER ({cents} <= 0) AS non_positive
  FROM raw"""


def _large(name: str, cents: str) -> str:
    """As ``_numeric``, with the deviation from whole numbers and quartiles from places."""
    n, total, squares = (
        f"CAST({c} AS HUGEINT)" for c in (f"count({cents})", f"sum({cents})", f"sum(CAST({cents} AS HUGEINT) * {cents})")
    )
    spread = f"sqrt(CAST({n} * {squares} - {total} * {total} AS DOUBLE) / {n} / ({n} - 1)) / 100"
    return _numeric(name, cents).replace(f"stddev_samp({cents} / 100)", spread)


_RAW_QTY = "CAST(quantity AS BIGINT)"
_RAW_UNIT = "CASE WHEN unit_price <> 'n/a' THEN uc END"
_BLANKS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR {c} = '') AS blanks, "
    f"{_pct(f'count(*) FILTER ({c} IS NULL OR {c} = {chr(39)}{chr(39)})', 'count(*)')} AS blank_pct FROM raw"
    for c in _RAW_COLUMNS.split(", ")
)

_SEEN = (
    "SELECT name_id, d AS day, arg_max(uc, order_item_id) AS uc, arg_max(cat, order_item_id) AS cat, "
    "arg_max(sz, order_item_id) AS sz, arg_max(recipe, order_item_id) AS recipe "
    "FROM f GROUP BY name_id, d"
)

_PIVOT = ", ".join(
    f"count(DISTINCT CASE WHEN hr = {h} THEN order_id END) AS h{h:02d}" for h in range(24)
)

ORACLES: dict[str, str] = {
    # cleaning
    "raw_scan": _raw(f"SELECT {_RAW_COLUMNS} FROM raw"),
    "raw_csv_scan": _raw(f"SELECT {_RAW_COLUMNS} FROM raw"),
    "pipeline_tables": _judged(f"""SELECT "table", n AS rows, 'loaded' AS status FROM ({_TABLE_COUNTS})
    UNION ALL SELECT 'rejected_rows', count(reject_reason), 'loaded' FROM j
    UNION ALL SELECT 'source', count(*), 'read' FROM j
    UNION ALL SELECT 'rejection rate', CASE WHEN r * 100 < n THEN 0 ELSE r END,
      CASE WHEN r * 100 < n THEN 'PASS' ELSE 'WARN' END
    FROM (SELECT count(*) AS n, count(reject_reason) AS r FROM j)""", f"""
f AS (SELECT ok * 10 + ln AS order_item_id, ok AS order_id, d, CAST(d AS TIMESTAMP) AS ts,
    ok % 24 AS hr, lower(item_name_id) AS name_id, lower(item_name_id) AS code, item_name AS short,
    item_name AS name, item_category AS cat, upper(item_size) AS sz, item_ingredients AS recipe,
    q AS qty, uc, uc * q AS tc, src FROM j WHERE reject_reason IS NULL){_ITEMS}{_CAL}"""),
    "quarantine_rows": _judged(
        f"SELECT {_RAW_COLUMNS}, reject_reason FROM j WHERE reject_reason IS NOT NULL"
    ),
    "clean_rows": _judged(f"""SELECT ok * 10 + ln AS item_id, ok AS order_id,
    lower(item_name_id) AS item_name_id,
    CAST(d AS TIMESTAMP) + to_hours(ok % 24) + to_minutes(ok % 60) AS order_ts,
    CAST(q AS INTEGER) AS quantity, CAST({_money('uc')} AS DECIMAL(10,2)) AS unit_price,
    {_money('uc * q')} AS total_price, {_money('src')} AS total_price_source,
    abs(uc * q - src) > 1 AS price_variance_flag, upper(item_size) AS item_size,
    upper(left(item_category, 1)) || lower(substr(item_category, 2)) AS item_category,
    item_ingredients, item_name FROM j WHERE reject_reason IS NULL"""),
    "reject_summary": _judged(
        "SELECT reject_reason, count(*) AS rejected FROM j WHERE reject_reason IS NOT NULL GROUP BY 1"
    ),
    "run_summary": _judged("""SELECT count(*) AS source_rows,
    count(reject_reason) AS rejected_rows, count(*) - count(reject_reason) AS fact_rows,
    count(*) FILTER (reject_reason IS NULL AND abs(uc * q - src) > 1) AS price_variances FROM j"""),
    "dedup_line_key": f"""WITH {_DEDUP} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_quantity AS INTEGER) AS quantity, {_money(_EXT)} AS amount FROM s8""",
    "dedup_line_content": _retail(
        "", "SELECT order_item_id, order_id, name_id AS item_name_id, qty AS quantity FROM f"
    ),
    "text_hygiene": r"""WITH c AS (SELECT doc_id, source,
    trim(regexp_replace(CASE WHEN doc_id % 7 = 3 THEN 'fine ABC 12 ' ELSE '' END || nfc_normalize(text), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS clean
  FROM documents) SELECT doc_id, length(clean) AS clean_chars, md5(clean) AS clean_md5,
    upper(left(source, 1)) || lower(substr(source, 2)) AS source_title FROM c""",
    "day_part_range_join": _counter("", f"SELECT {_PART} AS day_part, count(*) AS lines FROM f GROUP BY 1"),
    # star schema
    "dim_date": _retail(_CAL, f"SELECT {_calendar_row('d')} FROM cal"),
    "dim_time": f"SELECT {_TIME_ROW} FROM (SELECT range AS hr FROM range(24))",
    "dim_product": _retail(_ITEMS, f"""SELECT item_key, name_id AS item_name_id, code AS product_code,
    name AS item_name, short AS item_short_name, cat AS item_category, sz AS item_size, size_label,
    size_sort AS size_sort_order, CAST({_money('mid')} AS DECIMAL(10,2)) AS unit_price,
    CAST({_money('lo')} AS DECIMAL(10,2)) AS min_unit_price,
    CAST({_money('hi')} AS DECIMAL(10,2)) AS max_unit_price, hi - lo <= 1 AS price_is_stable,
    CAST(len(string_split(recipe, ',')) AS INTEGER) AS ingredient_count,
    NOT regexp_matches(lower(recipe), '{_MEAT}') AS is_vegetarian, recipe AS item_ingredients
    FROM item"""),
    "dim_ingredient": _retail(
        _ITEMS, "SELECT ingredient_key, ingredient AS ingredient_name, is_cheese FROM ingr"
    ),
    "ingredient_bridge": _retail(
        _ITEMS, "SELECT item_key, ingredient_key FROM link JOIN ingr USING (ingredient)"
    ),
    "fact_order_items": _retail(_ITEMS, _FACT),
    "order_context": _retail("", f"""SELECT order_item_id, order_id, count(*) OVER o AS order_line_count,
    {_big('sum(qty) OVER o')} AS order_item_count, {_money('sum(tc) OVER o')} AS order_total_value
    FROM f WINDOW o AS (PARTITION BY order_id)"""),
    "scd2_product": _retail("", f"""SELECT name_id AS item_name_id,
    CAST(row_number() OVER w AS INTEGER) AS version,
    CAST({_money('uc')} AS DECIMAL(10,2)) AS unit_price, cat AS item_category, sz AS item_size,
    recipe AS item_ingredients, day AS valid_from,
    CAST(lead(day) OVER w - INTERVAL 1 DAY AS DATE) AS valid_to,
    lead(day) OVER w IS NULL AS is_current
    FROM (SELECT *, row_number() OVER k AS n, lag(uc) OVER k AS puc, lag(cat) OVER k AS pcat,
        lag(sz) OVER k AS psz, lag(recipe) OVER k AS precipe FROM ({_SEEN})
      WINDOW k AS (PARTITION BY name_id ORDER BY day))
    WHERE n = 1 OR puc IS DISTINCT FROM uc OR pcat IS DISTINCT FROM cat
      OR psz IS DISTINCT FROM sz OR precipe IS DISTINCT FROM recipe
    WINDOW w AS (PARTITION BY name_id ORDER BY day)"""),
    "recipe_flags": f"""WITH {_PLANTED}{_ITEMS}
    SELECT name_id AS name, CAST(len(string_split(recipe, ',')) AS INTEGER) AS ingredient_count,
      NOT regexp_matches(lower(recipe), '{_MEAT}') AS flag FROM item
    UNION ALL SELECT ingredient, 1, is_cheese FROM ingr""",
    "loaded_content": _retail(_ITEMS + _CAL, f"""SELECT 'dim_date' AS "table",
      {_big("sum(CAST(strftime(d, '%Y%m%d') AS INTEGER))")} AS content FROM cal
    UNION ALL SELECT 'dim_time', {_big('sum(range * range)')} FROM range(24)
    UNION ALL SELECT 'dim_item', {_big("sum(item_key * len(string_split(recipe, ',')))")} FROM item
    UNION ALL SELECT 'dim_ingredient', {_big('sum(ingredient_key * length(ingredient))')} FROM ingr
    UNION ALL SELECT 'bridge_item_ingredient', {_big('sum(item_key * 1000 + ingredient_key)')}
      FROM link JOIN ingr USING (ingredient)
    UNION ALL SELECT 'fact_order_items', {_big('sum(order_item_id + item_key * qty)')}
      FROM f JOIN item USING (name_id)"""),
    "write_star": _retail(
        _ITEMS + _CAL, f'SELECT "table", n AS rows FROM ({_TABLE_COUNTS})'
    ),
    "load_verification": _retail(_ITEMS + _CAL, f"""SELECT "table", n AS loaded_rows, n AS source_rows,
    'OK' AS status, {_money('(SELECT sum(tc) FROM f)')} AS total_revenue FROM ({_TABLE_COUNTS})"""),
    # views
    "fact_enriched": _retail(_ITEMS + _CAL, f"""SELECT order_item_id, order_id, order_ts, full_date,
    year, quarter_name, year_month, month_name, month_number, iso_week, day_name, day_of_week,
    is_weekend, hour_24, hour_label, day_part, is_peak_window, name AS item_name,
    short AS item_short_name, cat AS item_category, sz AS item_size, size_label,
    size_sort AS size_sort_order, NOT regexp_matches(lower(recipe), '{_MEAT}') AS is_vegetarian,
    CAST(len(string_split(recipe, ',')) AS INTEGER) AS ingredient_count, quantity, unit_price,
    total_price, order_line_count, order_item_count, order_total_value
    FROM ({_FACT}) JOIN item USING (item_key)
    JOIN (SELECT {_calendar_row('d')} FROM cal) USING (date_key)
    JOIN (SELECT {_TIME_ROW} FROM (SELECT range AS hr FROM range(24))) USING (time_key)"""),
    "kpi_headline": _retail("", _KPI),
    "daily_sales": _retail(_DAYS, _DAILY),
    "monthly_trend": _retail(_MONTHS, _MONTHLY),
    "sales_by_category": _retail("", _CATEGORY),
    "sales_by_size": _retail("", _BY_SIZE),
    "hourly_demand": _counter(_HOURS, _HOURLY),
    "weekday_hour_heatmap": _counter("", f"""SELECT CAST(isodow(d) AS INTEGER) AS day_of_week,
    strftime(d, '%a') AS day_short, CAST(hr AS INTEGER) AS hour_24, {_LABEL} AS hour_label,
    count(DISTINCT order_id) AS orders, {_money('sum(tc)')} AS revenue,
    {_ratio('count(DISTINCT order_id)', 'count(DISTINCT d)', 1)} AS avg_orders_per_occurrence
    FROM f GROUP BY isodow(d), strftime(d, '%a'), hr"""),
    "product_performance": _retail(_PRODUCTS, _PERF),
    "basket_profile": _retail(_BASKETS, _BASKET),
    "product_affinity": _retail(_PAIRS, "SELECT * FROM aff"),
    "supplier_affinity": f"""WITH sp AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
    nn AS (SELECT count(DISTINCT s) AS n FROM sp), sg AS (SELECT p, count(*) AS cnt FROM sp GROUP BY p),
    pc AS (SELECT x.p AS a, y.p AS b, count(*) AS k FROM sp x JOIN sp y ON x.s = y.s AND x.p < y.p
      GROUP BY 1, 2 HAVING count(*) >= 12)
    SELECT a AS part_a, b AS part_b, k AS suppliers_together, {_pct('k', 'n', 3)} AS support_pct,
      {_pct('k', 'sa.cnt')} AS confidence_a_to_b_pct, {_pct('k', 'sb.cnt')} AS confidence_b_to_a_pct,
      {_ratio('k * n', 'sa.cnt * sb.cnt', 3)} AS lift
    FROM pc JOIN sg sa ON sa.p = a JOIN sg sb ON sb.p = b CROSS JOIN nn""",
    "ingredient_exposure": _retail(_ITEMS + _EXPOSURE, _EXP),
    # analyst questions
    "q01_headline": _counter("", _KPI),
    "q02_monthly": _retail(_MONTHS, f"""SELECT year_month, revenue, prev_month_revenue,
    mom_growth_pct, pct_of_year_revenue FROM ({_MONTHLY})"""),
    "q03_weekday_pattern": _retail("", f"""SELECT strftime(d, '%A') AS day_name,
    CAST(isodow(d) AS INTEGER) AS day_of_week, count(DISTINCT d) AS days_traded,
    {_money('sum(tc)')} AS revenue,
    {_ratio('sum(tc)', 'count(DISTINCT d) * 100', 2)} AS avg_revenue_per_day,
    {_ratio('count(DISTINCT order_id)', 'count(DISTINCT d)', 1)} AS avg_orders_per_day
    FROM f GROUP BY strftime(d, '%A'), isodow(d)"""),
    "q04_day_part": _counter(_HOURS, f"""SELECT {_PART} AS day_part, {_big('sum(orders)')} AS orders,
    {_pct('sum(orders)', '(SELECT sum(orders) FROM h)')} AS pct_of_orders,
    {_money('sum(rev)')} AS revenue FROM h GROUP BY 1"""),
    "q05_pareto": _retail(_PRODUCTS, f"""SELECT rr AS revenue_rank, short AS item_short_name,
    cat AS item_category, {_money('rev')} AS revenue, pct AS pct_of_revenue,
    cum AS cumulative_pct_of_revenue, abc AS abc_class FROM perf"""),
    "q06_delist": _retail(_PRODUCTS, f"""SELECT short AS item_short_name, cat AS item_category,
    {_big('units')} AS items_sold, {_money('rev')} AS revenue, pct AS pct_of_revenue
    FROM perf WHERE abc = 'C'"""),
    "q07_levers": _retail("", f"""SELECT 'size' AS lever, item_size AS value, pct_of_revenue
    FROM ({_BY_SIZE}) UNION ALL SELECT 'category', item_category, pct_of_revenue FROM ({_CATEGORY})"""),
    "q08_cross_sell": _retail(_PAIRS, """SELECT product_a, product_b, orders_together, support_pct,
    confidence_a_to_b_pct, lift FROM aff WHERE lift > 1
    ORDER BY lift DESC, orders_together DESC, product_a, product_b LIMIT 20"""),
    "q08_affinity_matrix": _retail(
        _PAIRS, "SELECT product_a, product_b, lift FROM aff WHERE lift > 0.95"
    ),
    "q09_basket": _retail(_BASKETS, _BASKET),
    "q10_ingredients": _retail(_ITEMS + _EXPOSURE, f"""SELECT ingredient_name, products_using,
    items_sold, attributed_revenue, pct_of_revenue FROM ({_EXP})
    ORDER BY attributed_revenue DESC, ingredient_name LIMIT 20"""),
    "q11_best_worst_days": _retail(_DAYS, f"""(SELECT 'best' AS bucket, full_date, day_name, revenue,
    orders FROM ({_DAILY}) ORDER BY revenue DESC, full_date LIMIT 5) UNION ALL
    (SELECT 'worst', full_date, day_name, revenue, orders FROM ({_DAILY})
    ORDER BY revenue, full_date LIMIT 5)"""),
    "q12_zero_sales_days": _retail(_CAL, """SELECT cal.d AS full_date, strftime(cal.d, '%A') AS day_name
    FROM cal LEFT JOIN f ON f.d = cal.d WHERE f.order_item_id IS NULL"""),
    "q13_reconciliation": _retail("", """SELECT count(*) FILTER (uc * qty <> tc)
    AS rows_breaking_price_rule FROM f"""),
    # quality gate
    "dq_report": _retail(_ITEMS + _CAL, f"""SELECT "check", severity, bad_count, {_STATUS} AS status,
    CASE WHEN bad_count = 0 THEN '' ELSE bad_count || ' ' || text END AS detail FROM ({_checks()})"""),
    "dq_summary": _retail(_ITEMS + _CAL, f"""SELECT count(*) FILTER (s = 'PASS') AS passed,
    count(*) FILTER (s = 'WARN') AS warnings, count(*) FILTER (s = 'FAIL') AS failures,
    CAST(count(*) FILTER (s = 'FAIL') > 0 AS INTEGER) AS exit_status
    FROM (SELECT {_STATUS} AS s FROM ({_checks()}))"""),
    "dq_constraints": _retail(_ITEMS + _CAL, _constraints()),
    "dq_unexpected_categories": _retail(
        "", f"SELECT DISTINCT cat AS item_category FROM f WHERE cat NOT IN {_DOMAIN}"
    ),
    "dq_rejection_rate": _judged(f"""SELECT count(reject_reason) AS rejected,
    {_pct('count(reject_reason)', 'count(*)', 3)} AS rejected_pct FROM j"""),
    # profile
    "profile_volume": _raw("""SELECT count(*) AS rows, CAST(12 AS INTEGER) AS columns,
    count(DISTINCT item_id) AS distinct_item_id, count(DISTINCT order_id) AS distinct_order_id,
    count(DISTINCT item_id) = count(*) AS item_id_is_key FROM raw"""),
    "profile_completeness": _raw(_BLANKS),
    "profile_duplicates": _raw(f"""SELECT (SELECT count(*) FROM raw) -
    (SELECT count(*) FROM (SELECT DISTINCT {_RAW_COLUMNS} FROM raw)) AS duplicate_rows,
    (SELECT count(*) - count(DISTINCT item_id) FROM raw) AS duplicate_item_id"""),
    "profile_domains": _raw(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS rows,
    {_pct('count(*)', '(SELECT count(*) FROM raw)')} AS pct FROM raw GROUP BY {c}"""
        for c in ("item_size", "item_category")
    )),
    "profile_numeric": _raw(" UNION ALL ".join([
        _numeric("quantity", f"(100 * {_RAW_QTY})"),
        _numeric("unit_price", f"({_RAW_UNIT})"),
        _numeric("total_price", "src"),
    ])),
    "profile_large_amounts": _raw(" UNION ALL ".join([
        _large("quantity", f"(100 * {_RAW_QTY})"),
        _large("unit_price", "(CASE WHEN order_id <> '' THEN 1650170190701 END)"),
        _large("total_price", "(100000000000 + 50 * (CAST(order_id AS BIGINT) % 2))"),
    ])),
    "profile_dates": _raw("""SELECT count(*) FILTER (order_date LIKE '%/%') AS bad_order_date,
    count(*) FILTER (order_time = '25:00:00') AS bad_order_time,
    min(d) FILTER (order_date NOT LIKE '%/%') AS first_date,
    max(d) FILTER (order_date NOT LIKE '%/%') AS last_date,
    count(DISTINCT CASE WHEN order_date NOT LIKE '%/%' THEN d END) AS days_covered FROM raw"""),
    "profile_rules": _raw(f"""SELECT count(*) FILTER (
      coalesce({_RAW_UNIT} * {_RAW_QTY} <> src, TRUE)) AS price_rule_breaks,
    count(DISTINCT item_name_id) AS item_name_ids, count(DISTINCT item_name) AS item_names FROM raw"""),
    "profile_fd": _raw(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (n > 1) AS conflicting_keys
    FROM (SELECT count(DISTINCT {c}) AS n FROM raw GROUP BY item_name_id)"""
        for c in ("item_name", "item_category", "item_size", "unit_price")
    )),
    "profile_redundancy": _raw(
        "SELECT count(*) AS rows, count(DISTINCT item_ingredients) AS distinct_recipes FROM raw"
    ),
    # insight numbers
    "insight_metrics": _retail(_MONTHS, f"""SELECT
    (SELECT ym FROM m ORDER BY rev DESC, month_start LIMIT 1) AS best_month,
    {_money('(SELECT max(rev) FROM m)')} AS best_month_revenue,
    (SELECT ym FROM m ORDER BY rev, month_start LIMIT 1) AS worst_month,
    {_money('(SELECT min(rev) FROM m)')} AS worst_month_revenue,
    (SELECT max(abs(mom_growth_pct)) FROM ({_MONTHLY})) AS max_abs_mom_pct,
    (SELECT CAST(max(d) - min(d) + 1 AS BIGINT) FROM f) AS calendar_days,
    (SELECT count(DISTINCT d) FROM f) AS trading_days,
    (SELECT CAST(max(d) - min(d) + 1 AS BIGINT) - count(DISTINCT d) FROM f) AS zero_sales_days"""),
    "insight_hours": _counter(_HOURS, f"""SELECT
    (SELECT {_LABEL} FROM h ORDER BY orders DESC, hr LIMIT 1) AS busiest_hour,
    (SELECT max(orders) FROM h) AS peak_hour_orders,
    (SELECT string_agg({_LABEL}, ',' ORDER BY hr) FROM h WHERE orders = (SELECT max(orders) FROM h)) AS busiest_hours,
    {_pct(f"(SELECT sum(orders) FROM h WHERE {_PART} IN ('Lunch', 'Dinner'))",
          '(SELECT sum(orders) FROM h)', 1)} AS lunch_dinner_pct"""),
    "peak_hours_flag": _counter(_HOURS, f"""SELECT CAST(hr AS INTEGER) AS hour_24, {_LABEL} AS hour_label,
    orders, {_ratio('(SELECT sum(orders) FROM h)', '(SELECT count(*) FROM h)', 2)} AS avg_orders,
    orders > {_ratio('(SELECT sum(orders) FROM h)', '(SELECT count(*) FROM h)', 2)} AS above_average,
    orders >= (SELECT quantile_cont(orders, 0.8) FROM h) AS top_quintile FROM h"""),
    "insight_weekday_gap": _retail(_DAYS + f""",
    w AS (SELECT strftime(d, '%A') AS dn, {_ratio('sum(rev)', 'count(*) * 100', 2)} AS a FROM day GROUP BY 1)""",
    f"""SELECT (SELECT dn FROM w ORDER BY a DESC, dn DESC LIMIT 1) AS best_day,
    (SELECT max(a) FROM w) AS best_avg_revenue,
    (SELECT dn FROM w ORDER BY a, dn LIMIT 1) AS worst_day,
    (SELECT min(a) FROM w) AS worst_avg_revenue,
    {_pct('(SELECT (max(a) - min(a)) * 100 FROM w)', '(SELECT min(a) * 100 FROM w)', 0)} AS gap_pct"""),
    "insight_abc": _retail(_PRODUCTS, """SELECT count(*) AS products,
    count(*) FILTER (abc = 'A') AS a_products, count(*) FILTER (abc = 'C') AS c_products,
    CAST(coalesce(sum(pct) FILTER (abc = 'C'), 0) AS DECIMAL(18,2)) AS c_pct_of_revenue,
    (SELECT code FROM perf ORDER BY rev DESC, code DESC LIMIT 1) AS top_product,
    (SELECT pct FROM perf ORDER BY rev DESC, code DESC LIMIT 1) AS top_pct,
    (SELECT code FROM perf ORDER BY rev, code LIMIT 1) AS bottom_product,
    (SELECT pct FROM perf ORDER BY rev, code LIMIT 1) AS bottom_pct FROM perf"""),
    "insight_mix": _retail("", f"""SELECT
    (SELECT CAST(max(pct_of_revenue) - min(pct_of_revenue) AS DECIMAL(18,2)) FROM ({_CATEGORY})) AS category_spread_points,
    (SELECT item_category FROM ({_CATEGORY}) ORDER BY revenue DESC, item_category DESC LIMIT 1) AS top_category,
    (SELECT max(pct_of_revenue) FROM ({_CATEGORY})) AS top_category_pct,
    (SELECT item_size FROM ({_BY_SIZE}) ORDER BY revenue DESC, item_size DESC LIMIT 1) AS top_size,
    (SELECT max(pct_of_revenue) FROM ({_BY_SIZE})) AS top_size_pct"""),
    "insight_basket": _retail(_BASKETS, f"""SELECT
    {_pct('count(*) FILTER (items = 1)', 'count(*)')} AS single_item_pct,
    {_ratio('sum(val)', 'count(*) * 100', 2)} AS avg_order_value,
    {_ratio('sum(items)', 'count(*)', 2)} AS avg_items_per_order FROM b"""),
    # BI measures
    "kpi_sliced": _retail("", f"""SELECT {_measures('cat AS item_category')} FROM f
    WHERE d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND cat IN ('Economy', 'Promo')
    AND sz IN ('M', 'L') GROUP BY cat"""),
    "kpi_sliced_days": _retail("", f"""SELECT {_measures('sz AS item_size')} FROM f
    WHERE d BETWEEN DATE '1995-02-10' AND DATE '1997-03-20' AND cat = 'Economy' GROUP BY sz"""),
    "kpi_sliced_lines": _retail("", f"""SELECT {_measures('cat AS item_category')} FROM f
    WHERE d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND cat IN ('Economy', 'Promo')
    AND sz IN ('M', 'L') GROUP BY cat"""),
    "kpi_sliced_day_part": _counter("", f"""SELECT {_measures(_PART + ' AS day_part')} FROM f
    WHERE strftime(d, '%Y-%m') = '2024-01' AND {_PART} IN ('Lunch', 'Dinner') GROUP BY {_PART}"""),
    "selected_metric": _retail("", f"""SELECT cat AS item_category, 'Average Order Value' AS metric,
    {_ratio('sum(tc)', 'count(DISTINCT order_id) * 100', 2)} AS value FROM f GROUP BY cat"""),
    "mom_calendar": _retail(_MONTHS, f"""SELECT a.ym AS year_month, {_money('a.rev')} AS revenue,
    {_money('b.rev')} AS revenue_pm, {_pct('a.rev - b.rev', 'b.rev')} AS mom_growth_pct
    FROM m a LEFT JOIN m b ON b.m1 + INTERVAL 1 MONTH = a.m1"""),
    "mom_abs_prev": _retail(_MONTHS, f"""SELECT ym AS year_month, {_money('rev')} AS revenue,
    {_pct('rev - lag(rev) OVER w', 'abs(lag(rev) OVER w)')} AS mom_pct
    FROM m WINDOW w AS (ORDER BY month_start)"""),
    "ytd_revenue": _retail(_CAL + _DAYS, f"""SELECT cal.d AS full_date,
    {_money('coalesce(rev, 0)')} AS revenue,
    {_money('coalesce(sum(rev) OVER (PARTITION BY year(cal.d) ORDER BY cal.d), 0)')} AS revenue_ytd
    FROM cal LEFT JOIN day USING (d)"""),
    "moving_avg_calendar": _retail(_CAL + _DAYS, f"""SELECT cal.d AS full_date, {_money('rev')} AS revenue,
    {_ratio('sum(rev) OVER w', '(count(rev) OVER w) * 100', 2)} AS revenue_7d_calendar_avg
    FROM cal LEFT JOIN day USING (d) WINDOW w AS (ORDER BY cal.d
    RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"""),
    "share_of_selected": _retail("", f"""SELECT cat AS item_category, {_money('sum(tc)')} AS revenue,
    {_pct('sum(tc)', "(SELECT sum(tc) FROM f WHERE sz IN ('S', 'XL'))")} AS pct_of_selected
    FROM f WHERE sz IN ('S', 'XL') GROUP BY cat"""),
    "pareto_dense": _retail(_PRODUCTS, f"""SELECT code AS product_code, {_money('rev')} AS revenue,
    dr AS revenue_rank, {_money('run_ties')} AS revenue_running_total,
    {_pct('run_ties', 't')} AS pareto_pct FROM pr"""),
    "pareto_band": _retail(_PRODUCTS, f"""SELECT code AS product_code, {_money('rev')} AS revenue,
    CASE WHEN run * 100 <= t * 80 THEN 'A - top 80% of revenue'
    WHEN run * 100 <= t * 95 THEN 'B - next 15%' ELSE 'C - tail' END AS band FROM pr"""),
    "pareto_local_variant": _retail(_PRODUCTS + """,
    lv AS (SELECT *, CAST(sum(pct) OVER (ORDER BY rn) AS DECIMAL(18,2)) AS c2 FROM pp)""",
    f"""SELECT code AS product_code, {_money('rev')} AS revenue, rn AS revenue_rank,
    pct AS pct_of_revenue, c2 AS cumulative_pct_of_revenue,
    CASE WHEN c2 <= 0 THEN 'nan' WHEN c2 <= 80 THEN 'A' WHEN c2 <= 95 THEN 'B'
    WHEN c2 <= 101 THEN 'C' ELSE 'nan' END AS abc_class FROM lv"""),
    "abc_right_closed": _retail(_PRODUCTS + """,
    lv AS (SELECT *, CAST(sum(pct) OVER (ORDER BY rn) AS DECIMAL(18,2)) AS c2 FROM pp)""",
    """SELECT CASE WHEN c2 <= 0 THEN 'nan' WHEN c2 <= 80 THEN 'A' WHEN c2 <= 95 THEN 'B'
    WHEN c2 <= 101 THEN 'C' ELSE 'nan' END AS abc_class, count(*) AS products FROM lv GROUP BY 1"""),
    "pareto_by_day_part": "WITH " + _EVENTS.replace("f AS (", "g AS (")
    + f", f AS (SELECT * FROM g WHERE {_PART} = 'Lunch'){_PRODUCTS} {_PERF}",
    "top_n_products": _retail(_PRODUCTS, f"""SELECT code AS product_code, {_money('rev')} AS revenue,
    rr AS revenue_rank FROM pr WHERE rr <= 10"""),
    **{
        name: _retail(_PRODUCTS, f"""SELECT code AS product_code, cat AS item_category,
    {_money('rev')} AS revenue, {_big('units')} AS items_sold FROM p
    ORDER BY rev {way}, code LIMIT {n}""")
        for name, way, n in (
            ("top15_products", "DESC", 15), ("top5_products", "DESC", 5),
            ("bottom10_products", "ASC", 10),
        )
    },
    "price_vs_volume": _retail(_PRODUCTS, f"""SELECT code AS product_code, cat AS item_category,
    {_big('units')} AS items_sold, {_ratio('rev', 'units * 100', 2)} AS avg_unit_price,
    {_money('rev')} AS revenue FROM p"""),
    "menu_quadrant": _retail(_ITEMS + _PRODUCTS + f""",
    lp AS (SELECT code, {_ratio('sum(mid)', 'count(*) * 100', 2)} AS list_price FROM item GROUP BY code),
    pt AS (SELECT * FROM p JOIN lp USING (code)),
    md AS (SELECT median(units) AS mu, median(CAST(list_price AS DOUBLE)) AS mp FROM pt)""",
    f"""SELECT code AS product_code, {_big('units')} AS items_sold, list_price,
    {_money('rev')} AS revenue,
    CASE WHEN units >= mu AND CAST(list_price AS DOUBLE) >= mp THEN 'star'
    WHEN units >= mu THEN 'volume driver' WHEN CAST(list_price AS DOUBLE) >= mp THEN 'margin driver'
    ELSE 'delist candidate' END AS quadrant FROM pt CROSS JOIN md"""),
    "peak_window_share": _counter("", f"""SELECT
    count(DISTINCT CASE WHEN {_PART} IN ('Lunch', 'Dinner') THEN order_id END) AS peak_orders,
    count(DISTINCT order_id) AS orders,
    {_pct(f"count(DISTINCT CASE WHEN {_PART} IN ('Lunch', 'Dinner') THEN order_id END)",
          'count(DISTINCT order_id)')} AS peak_window_pct FROM f"""),
    "heatmap_pivot": _counter("", f"""SELECT CAST(isodow(d) AS INTEGER) AS day_of_week,
    strftime(d, '%a') AS day_short, {_PIVOT} FROM f GROUP BY isodow(d), strftime(d, '%a')"""),
    "attach_rate": _retail("", f"""SELECT code AS product_code, count(DISTINCT order_id) AS orders,
    {_pct('count(DISTINCT order_id)', '(SELECT count(DISTINCT order_id) FROM f)')} AS attach_rate_pct
    FROM f GROUP BY code"""),
    "affinity_means": _retail(_PAIRS, f"""SELECT count(*) AS pairs,
    {_ratio('sum(lift * 1000)', 'count(*) * 1000', 3)} AS avg_lift,
    {_ratio('sum(confidence_a_to_b_pct * 100)', 'count(*) * 100', 2)} AS avg_confidence_pct FROM aff"""),
    "basket_lod": _retail(_BASKETS, f"""SELECT CASE WHEN items > 1 THEN 'Multi-item'
    ELSE 'Single item' END AS order_kind, count(*) AS orders, {_money('sum(val)')} AS revenue,
    {_ratio('sum(val)', 'count(*) * 100', 2)} AS avg_basket_value FROM b GROUP BY 1"""),
    "ingredient_concentration": _retail(_ITEMS + _EXPOSURE, f"""SELECT
    count(*) FILTER (pct_of_revenue > 25) AS ingredients_above, count(*) AS ingredients
    FROM ({_EXP})"""),
    "data_trust": _retail("", """SELECT n AS price_variance_rows, CASE WHEN n = 0
    THEN 'All rows reconciled' ELSE 'Review ' || n || ' rows' END AS data_trust_label
    FROM (SELECT count(*) FILTER (abs(tc - src) > 1) AS n FROM f)"""),
    "calendar_rollup": _retail("", f"""SELECT CAST(year AS INTEGER) AS year, quarter_name, year_month,
    full_date, {_big('grouping(year, quarter_name, year_month, full_date)')} AS level,
    {_money('sum(tc)')} AS revenue, {_big('sum(qty)')} AS items_sold
    FROM (SELECT year(d) AS year, 'Q' || quarter(d) || ' ' || year(d) AS quarter_name,
      strftime(d, '%Y-%m') AS year_month, d AS full_date, tc, qty FROM f)
    GROUP BY ROLLUP (year, quarter_name, year_month, full_date)"""),
    "grouping_sets_mix": _retail("", f"""SELECT cat AS item_category, sz AS item_size,
    {_money('sum(tc)')} AS revenue, {_big('sum(qty)')} AS items_sold FROM f
    GROUP BY GROUPING SETS ((cat), (sz), ())"""),
    # streams
    "stream_incremental": _counter("", f"""SELECT d AS day, count(*) AS lines,
    {_money('sum(tc)')} AS revenue FROM e GROUP BY d"""),
    "stream_hourly_arrivals": """
        WITH lines AS (
          SELECT event_id % 6 AS delivery, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end, ts
          FROM events
        ), marks AS (
          SELECT delivery, date_trunc('millisecond', max(max(ts)) OVER (
            ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)) - INTERVAL 1 HOUR AS mark
          FROM lines GROUP BY delivery
        ), kinds AS (
          SELECT CASE WHEN hour_end <= mark THEN 'late'
            WHEN hour_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM lines)
              THEN 'closed' ELSE 'open' END AS kind
          FROM lines JOIN marks USING (delivery)
        )
        SELECT kind, count(*) AS lines FROM kinds GROUP BY kind""",
    "stream_hourly": _counter("", f"""SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start,
    count(*) AS lines, {_money('sum(tc)')} AS revenue FROM e GROUP BY 1"""),
    "stream_quarantine": _judged("""SELECT coalesce(reject_reason, 'accepted') AS outcome,
    count(*) AS rows FROM j GROUP BY 1"""),
}
ORACLES["view_by_name"] = ORACLES["extract_read_back"] = ORACLES["monthly_trend"]

# What is kept up to date must be what a rebuild gives.
ORACLES["scd2_updated"] = ORACLES["scd2_product"]
ORACLES["tables_by_name"] = ORACLES["write_star"]
