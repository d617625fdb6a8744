"""The registered queries as DuckDB SQL over the same tables.

Written against the tables alone; nothing here runs on Spark.
"""

from __future__ import annotations

# The channels, their labels, statuses and words, as the star schema holds them.
CHANNELS = {
    "shopify": "1-URGENT",
    "mercadolibre": "2-HIGH",
    "amazon": "3-MEDIUM",
    "tiendanube": "4-NOT SPECIFIED",
    "pos": "5-LOW",
}
CHANNEL = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{c}'" for c, p in CHANNELS.items())
    + " END"
)
PLATFORMS = """platforms(source_platform, platform_id, platform_name, platform_type) AS (VALUES
  ('shopify', 1, 'Shopify', 'ecommerce'), ('mercadolibre', 2, 'MercadoLibre', 'marketplace'),
  ('amazon', 3, 'Amazon', 'marketplace'), ('tiendanube', 4, 'Tiendanube', 'ecommerce'),
  ('pos', 5, 'Tienda Física', 'pos'))"""
STATUSES = """statuses(source_platform, raw_status, canonical_status) AS (VALUES
  ('shopify', 'paid', 'paid'), ('shopify', 'pending', 'pending'),
  ('shopify', 'refunded', 'refunded'), ('shopify', 'partially_refunded', 'partially_refunded'),
  ('mercadolibre', 'paid', 'paid'), ('mercadolibre', 'cancelled', 'cancelled'),
  ('mercadolibre', 'refunded', 'refunded'), ('amazon', 'Shipped', 'paid'),
  ('amazon', 'Pending', 'pending'), ('amazon', 'Cancelled', 'cancelled'),
  ('amazon', 'Refunded', 'refunded'), ('tiendanube', 'Pagado', 'paid'),
  ('tiendanube', 'Pendiente de pago', 'pending'), ('tiendanube', 'Cancelado', 'cancelled'),
  ('tiendanube', 'Reembolsado', 'refunded'), ('pos', 'EFECTIVO', 'paid'),
  ('pos', 'TARJETA', 'paid'), ('pos', 'YAPE', 'paid'), ('pos', 'PLIN', 'paid'))"""
FX = """days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
fx AS (
  SELECT 'USD' AS currency, d AS rate_date, CAST(1 AS DECIMAL(12,6)) AS rate FROM days
  UNION ALL
  SELECT 'PEN', d, CAST((250 + dayofyear(d) % 50) * CAST(0.001 AS DECIMAL(12,6)) AS DECIMAL(12,6))
  FROM days WHERE isodow(d) < 6 AND d <= DATE '2000-12-31'),
latest AS (SELECT currency, arg_max(rate, rate_date) AS rate FROM fx GROUP BY currency)"""

RAW_ID = """(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) * 1048576
  + (l_partkey * 1000003 + l_suppkey * 10007 + CAST(round(l_extendedprice * 100) AS BIGINT)) % 1048576)"""
QTY = "(CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INT) ELSE CAST(l_quantity AS INT) END)"
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
DISCOUNT = f"({PRICE} * CAST(l_discount AS DECIMAL(4,2)))"
EMAIL = "lower(c_name) || '@example.com'"
WALL = """(strftime(o_orderdate, '%Y-%m-%d') || 'T'
  || lpad(CAST(l_linenumber * 3 AS VARCHAR), 2, '0') || ':30:00')"""
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
BUYERS = f"{LINES} JOIN customer ON o_custkey = c_custkey"


def by_channel(channel: str, values: dict[str, str]) -> str:
    return f"CASE {channel} " + " ".join(f"WHEN '{c}' THEN '{v}'" for c, v in values.items()) + " END"


PREFIX = {"shopify": "SHP", "mercadolibre": "MLA", "amazon": "B0", "tiendanube": "tn", "pos": "POS"}
PAID = {
    "shopify": "paid",
    "mercadolibre": "paid",
    "amazon": "Shipped",
    "tiendanube": "Pagado",
    "pos": "EFECTIVO",
}
PENDING = {
    "shopify": "pending",
    "mercadolibre": "pending",
    "amazon": "Pending",
    "tiendanube": "Pendiente de pago",
    "pos": "FIADO",
}


def raw_status(channel: str) -> str:
    return (
        f"CASE o_orderstatus WHEN 'F' THEN {by_channel(channel, PAID)} "
        f"WHEN 'O' THEN {by_channel(channel, PENDING)} ELSE o_orderstatus END"
    )


def dressed(channel: str) -> str:
    prefix, part = f"({by_channel(channel, PREFIX)})", "CAST(l_partkey AS VARCHAR)"
    whole = f"{prefix} || ' ' || {part}"
    return f"""CASE l_linenumber % 4
      WHEN 0 THEN {whole}
      WHEN 1 THEN '  ' || lower({whole}) || ' '
      WHEN 2 THEN {prefix} || ' ' || chr(9) || ' ' || {part} || chr(9)
      ELSE chr(160) || upper({whole}) || chr(160) END"""


def cleaned(sku: str) -> str:
    return f"nullif(trim(regexp_replace({sku}, '[\\s\\x{{00A0}}]+', ' ', 'g')), '')"


def thousands(amount: str) -> str:
    return f"format('{{:,.2f}}', CAST({amount} AS DOUBLE))"


def money(text: str) -> str:
    kept = f"regexp_replace({text}, '[^0-9.,-]', '', 'g')"
    return f"TRY_CAST(replace({kept}, ',', '') AS DECIMAL(18,4))"


def stamp(instant: str) -> str:
    return f"strftime({instant}, '%Y-%m-%d %H:%M:%S')"


def utc(wall_text: str, hours: int = 5) -> str:
    return f"(CAST(substr({wall_text}, 1, 19) AS TIMESTAMP) + INTERVAL {hours} HOUR)"


MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
WEEKDAYS = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"


def calendar_parts(day: str) -> str:
    return f"""CAST(year({day}) AS BIGINT) AS year, CAST(quarter({day}) AS BIGINT) AS quarter,
      CAST(month({day}) AS BIGINT) AS month, {MONTHS}[month({day})] AS month_name,
      CAST(day({day}) AS BIGINT) AS day, CAST(isodow({day}) AS BIGINT) AS day_of_week,
      {WEEKDAYS}[isodow({day})] AS day_name, CAST(weekofyear({day}) AS BIGINT) AS week_of_year,
      isodow({day}) >= 6 AS is_weekend"""


# --- the sample lines, from text to staging -------------------------------------------

DRESSED_LINES = f"""dressed AS (
  SELECT {CHANNEL} AS source_platform, CAST(l_orderkey AS VARCHAR) AS platform_order_id,
    CAST(l_linenumber AS VARCHAR) AS platform_line_id, {WALL} || '-05:00' AS order_dt_raw,
    {dressed(CHANNEL)} AS platform_sku, CAST({QTY} AS VARCHAR) AS quantity,
    '$' || {thousands(PRICE)} AS unit_price_local,
    '$' || {thousands(f"CAST({DISCOUNT} AS DECIMAL(14,2))")} AS discount_local,
    '$' || {thousands(f"{PRICE} * {QTY}")} AS line_total_local,
    CASE WHEN {CHANNEL} IN ('shopify', 'amazon') THEN 'USD' ELSE 'PEN' END AS currency,
    {raw_status(CHANNEL)} AS raw_status, {RAW_ID} AS raw_id
  FROM {LINES})"""
CLEAN_LINES = f"""{DRESSED_LINES}, cleaned AS (
  SELECT source_platform, platform_order_id, platform_line_id, {utc("order_dt_raw")} AS order_dt_utc,
    {cleaned("platform_sku")} AS platform_sku, CAST(quantity AS INT) AS quantity,
    {money("unit_price_local")} AS unit_price_local, {money("discount_local")} AS discount_local,
    {money("line_total_local")} AS line_total_local, currency, raw_status, raw_id,
    CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS DECIMAL(18,4)) AS tax_local,
    CAST(NULL AS VARCHAR) AS customer_email, 0 AS element
  FROM dressed)"""
KEY = "source_platform, platform_order_id, platform_line_id"


def staging(source: str, name: str = "staging") -> str:
    """Dedupe, FX and status of an extracted relation; needs FX and STATUSES."""
    return f"""{name}_newest AS (
      SELECT * FROM {source} QUALIFY row_number() OVER (
        PARTITION BY {KEY} ORDER BY raw_id DESC, element DESC) = 1),
    {name} AS (
      SELECT n.source_platform, platform_order_id, platform_line_id, order_dt_utc, platform_sku,
        product_name, quantity, unit_price_local, discount_local, tax_local, line_total_local,
        n.currency,
        round(unit_price_local * coalesce(fx.rate, latest.rate), 4) AS unit_price_usd,
        round(line_total_local * coalesce(fx.rate, latest.rate), 4) AS line_total_usd,
        coalesce(canonical_status, 'unknown') AS order_status, customer_email, raw_id
      FROM {name}_newest n
      LEFT JOIN fx ON fx.currency = n.currency AND fx.rate_date = CAST(order_dt_utc AS DATE)
      LEFT JOIN latest ON latest.currency = n.currency
      LEFT JOIN statuses s ON s.source_platform = n.source_platform AND s.raw_status = n.raw_status
      WHERE order_dt_utc IS NOT NULL AND quantity IS NOT NULL)"""


AMOUNTS = [
    "unit_price_local", "discount_local", "tax_local", "line_total_local",
    "unit_price_usd", "line_total_usd",
]


def doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


STAGING_RESULT = f"""source_platform, platform_order_id, platform_line_id,
  {stamp("order_dt_utc")} AS order_dt_utc, platform_sku, product_name,
  CAST(quantity AS BIGINT) AS quantity, {doubles(*AMOUNTS)}, currency, order_status,
  customer_email, CAST(raw_id AS BIGINT) AS raw_id"""

# --- catalog and facts ------------------------------------------------------------------

CATALOG = """catalog AS (
  SELECT 'C' || p_partkey AS sku_canonical, p_name AS product_name, p_type AS category,
    CAST(p_retailprice AS DECIMAL(12,2)) AS base_price_usd, 'SHP ' || p_partkey AS shopify,
    'MLA ' || p_partkey AS mercadolibre, 'B0 ' || p_partkey AS amazon,
    'tn ' || p_partkey AS tiendanube, 'POS ' || p_partkey AS pos
  FROM part WHERE p_brand <> 'Brand#25'),
mapping AS (
  UNPIVOT catalog ON shopify, mercadolibre, amazon, tiendanube, pos
  INTO NAME source_platform VALUE platform_sku),
products AS (
  SELECT sku_canonical, product_name, category, base_price_usd,
    CAST(substr(sku_canonical, 2) AS INT) + 1 AS product_id FROM catalog)"""
FACTS = f"""{PLATFORMS}, {CATALOG}, facts AS (
  SELECT t.*, m.sku_canonical, p.product_id, platform_id, platform_name, platform_type,
    p.product_name AS canonical_name, p.category, CAST(order_dt_utc AS DATE) AS date_id
  FROM staging t JOIN platforms USING (source_platform)
  LEFT JOIN mapping m ON m.source_platform = t.source_platform
    AND lower(trim(m.platform_sku)) = lower(trim(t.platform_sku))
  LEFT JOIN products p ON p.sku_canonical = m.sku_canonical)"""
REVENUE = f"""SELECT CAST(year(date_id) AS BIGINT) AS year, CAST(month(date_id) AS BIGINT) AS month,
  {MONTHS}[month(date_id)] AS month_name, platform_name,
  coalesce(category, 'Sin categoría') AS category, count(*) AS line_items,
  CAST(sum(quantity) AS BIGINT) AS units,
  CAST(round(sum(CAST(line_total_usd AS DECIMAL(18,4))), 2) AS DOUBLE) AS revenue_usd
FROM facts WHERE order_status = 'paid' GROUP BY ALL"""

# --- extraction of the five channels -------------------------------------------------------


def extracted(channel: str, own_orders: bool) -> str:
    """Extracted and parsed lines of a channel, from all orders or its own."""
    mine = f"WHERE o_orderpriority = '{CHANNELS[channel]}'" if own_orders else ""
    literal = f"'{channel}'"
    none_amount, none_text = "CAST(NULL AS DECIMAL(18,4))", "CAST(NULL AS VARCHAR)"
    if channel == "mercadolibre":
        return f"""SELECT 'mercadolibre' AS source_platform,
          CAST(o_orderkey AS VARCHAR) AS platform_order_id,
          o_orderkey || '-' || i AS platform_line_id,
          o_orderdate + INTERVAL 26 HOUR + INTERVAL 15 MINUTE AS order_dt_utc,
          'mla ' || (o_custkey + i) AS platform_sku, 'Part ' || (o_custkey + i) AS product_name,
          i AS quantity, unit AS unit_price_local, CAST(0 AS DECIMAL(18,4)) AS discount_local,
          {none_amount} AS tax_local, CAST(unit * i AS DECIMAL(18,4)) AS line_total_local,
          'PEN' AS currency, {raw_status(literal)} AS raw_status,
          CASE WHEN o_orderstatus <> 'P' THEN 'b' || o_custkey || '@example.com' END AS customer_email,
          o_orderkey AS raw_id, i AS element
        FROM (SELECT *, unnest(range(1, o_orderkey % 4 + 2)) AS i,
            CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 4) // 8 * CAST(0.01 AS DECIMAL(4,2))
              AS DECIMAL(18,4)) AS unit
          FROM orders {mine})"""
    base = f"""SELECT {literal} AS source_platform, CAST(l_orderkey AS VARCHAR) AS platform_order_id"""
    tail = f"""{raw_status(literal)} AS raw_status"""
    part = "'Part ' || l_partkey"
    sku = cleaned(dressed(literal))
    total = f"CAST({PRICE} * {QTY} AS DECIMAL(18,4))"
    position = f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {RAW_ID})"
    if channel == "shopify":
        currency = "CASE WHEN l_linestatus = 'F' OR o_orderstatus <> 'P' THEN 'USD' END"
        sold = f"""{base}, CAST(l_linenumber AS VARCHAR) AS platform_line_id,
          {utc(WALL)} AS order_dt_utc, {sku} AS platform_sku, {part} AS product_name,
          {QTY} AS quantity, CAST({PRICE} AS DECIMAL(18,4)) AS unit_price_local,
          CAST({DISCOUNT} AS DECIMAL(18,4)) AS discount_local, {none_amount} AS tax_local,
          {total} AS line_total_local, {currency} AS currency, {tail},
          {EMAIL} AS customer_email, {RAW_ID} AS raw_id, 0 AS element FROM {BUYERS} {mine}"""
        gift_where = f"{mine} AND" if mine else "WHERE"
        gift = f"""{base}, CAST(l_linenumber + 100 AS VARCHAR), {utc(WALL)}, 'GIFT', 'Gift', 1,
          0, 0, NULL, 0, {currency}, {tail}, {EMAIL}, {RAW_ID}, 1
          FROM {BUYERS} {gift_where} l_returnflag = 'N'"""
        return f"{sold} UNION ALL {gift}"
    if channel == "amazon":
        return f"""{base}, l_orderkey || '-' || {position} AS platform_line_id,
          {utc(WALL)} AS order_dt_utc, {sku} AS platform_sku, {part} AS product_name,
          {QTY} AS quantity, CAST({PRICE} AS DECIMAL(18,4)) AS unit_price_local,
          {none_amount} AS discount_local,
          CAST(CAST({PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS DECIMAL(18,4)) AS tax_local,
          {total} AS line_total_local, 'USD' AS currency, {tail}, {EMAIL} AS customer_email,
          {RAW_ID} AS raw_id, 0 AS element FROM {BUYERS} {mine}"""
    if channel == "tiendanube":
        return f"""{base}, l_orderkey || '-' || {position} AS platform_line_id,
          o_orderdate + INTERVAL 5 HOUR AS order_dt_utc, {sku} AS platform_sku,
          {part} AS product_name, {QTY} AS quantity,
          CAST({PRICE} AS DECIMAL(18,4)) AS unit_price_local,
          CAST(CAST({DISCOUNT} AS DECIMAL(14,2)) AS DECIMAL(18,4)) AS discount_local,
          {none_amount} AS tax_local, {total} AS line_total_local, 'PEN' AS currency, {tail},
          {EMAIL} AS customer_email, {RAW_ID} AS raw_id, 0 AS element FROM {BUYERS} {mine}"""
    return f"""SELECT 'pos' AS source_platform,
      CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS platform_order_id,
      CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS platform_line_id,
      {utc(WALL)} AS order_dt_utc, {sku} AS platform_sku, {part} AS product_name,
      {QTY} AS quantity, CAST({PRICE} AS DECIMAL(18,4)) AS unit_price_local,
      CAST(CAST({DISCOUNT} AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS discount_local,
      {none_amount} AS tax_local, {total} AS line_total_local, 'PEN' AS currency, {tail},
      {none_text} AS customer_email, {RAW_ID} AS raw_id, 0 AS element FROM {BUYERS} {mine}"""


def normalized(channel: str) -> str:
    return (
        f"WITH {FX}, {STATUSES}, lines AS ({extracted(channel, False)}), {staging('lines')} "
        f"SELECT {STAGING_RESULT} FROM staging"
    )


ALL_LINES = "lines AS (" + " UNION ALL ".join(
    f"SELECT * FROM ({extracted(c, True)})" for c in CHANNELS
) + ")"
ALL_STAGING = f"{FX}, {STATUSES}, {ALL_LINES}, {staging('lines')}"
LINE_STAGING = f"{FX}, {STATUSES}, {CLEAN_LINES}, {staging('cleaned')}"
LINE_ID = f"l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST({RAW_ID} AS BIGINT) AS raw_id"
MAPPED = f"""{CLEAN_LINES}, {CATALOG}, mapped AS (
  SELECT c.*, m.sku_canonical, m.product_name AS canonical_product_name, m.category
  FROM cleaned c LEFT JOIN mapping m ON m.source_platform = c.source_platform
    AND lower(m.platform_sku) = lower(c.platform_sku))"""


def dedupe(keep: str) -> str:
    order = "DESC" if keep == "last" else "ASC"
    return f"""SELECT {LINE_ID}, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      {stamp("l_shipdate")} AS l_shipdate FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {RAW_ID} {order}) = 1"""


# --- quality rules -------------------------------------------------------------------------

FAULTY = f"""faulty AS (
  SELECT {CHANNEL} AS source_platform, CAST(l_orderkey AS VARCHAR) AS platform_order_id,
    CAST(l_linenumber AS VARCHAR) AS platform_line_id, o_orderdate AS order_dt_utc,
    CASE WHEN l_discount > 0 THEN CAST(l_quantity AS INT) ELSE 0 END AS quantity,
    CAST(c_acctbal AS DECIMAL(12,4)) AS price,
    CASE l_tax WHEN 0.08 THEN 'EUR' WHEN 0.07 THEN 'usd' WHEN 0.06 THEN NULL WHEN 0.05 THEN 'US'
      WHEN 0.04 THEN ' PEN ' WHEN 0.03 THEN 'SOLES' ELSE 'USD' END AS currency,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Pagado' WHEN l_returnflag = 'R' THEN 'refunded'
      ELSE 'paid' END AS order_status, {RAW_ID} AS raw_id
  FROM {BUYERS})"""
FUTURE = "order_dt_utc > TIMESTAMP '2001-06-02'"
SAID_FUTURE = """'order_dt_utc: Value error, order_dt_utc ' || strftime(order_dt_utc, '%Y-%m-%dT%H:%M:%S')
  || '+00:00 is in the future'"""
SAID_PRICE = """'unit_price_local: Value error, unit price must be non-negative, got '
  || regexp_replace(CAST(price AS VARCHAR), '0{1,3}$', '')"""
CURRENCY_CASES = """WHEN currency IS NULL THEN 'currency: Input should be a valid string'
  WHEN length(trim(currency)) < 3 THEN 'currency: String should have at least 3 characters'
  WHEN length(trim(currency)) > 3 THEN 'currency: String should have at most 3 characters'
  WHEN upper(trim(currency)) NOT IN ('USD', 'PEN')
    THEN 'currency: Value error, unsupported currency ''' || upper(trim(currency)) || ''''"""
STATUS_CASE = """WHEN order_status = 'Pagado'
  THEN 'order_status: Value error, unknown order_status ''Pagado'''"""
JUDGED = f"""{FAULTY}, judged AS (SELECT *, CASE WHEN {FUTURE} THEN {SAID_FUTURE}
  WHEN quantity = 0 THEN 'quantity: Value error, quantity cannot be zero'
  WHEN price < 0 THEN {SAID_PRICE} {CURRENCY_CASES} {STATUS_CASE} END AS reason FROM faulty)"""
PAYLOAD = """json_object('source_platform', source_platform, 'platform_order_id', platform_order_id,
  'platform_line_id', platform_line_id, 'order_dt_utc', strftime(order_dt_utc, '%Y-%m-%d %H:%M:%S'),
  'quantity', quantity, 'unit_price_local', CAST(price AS VARCHAR), 'discount_local', NULL,
  'tax_local', NULL, 'line_total_local', CAST(price AS VARCHAR), 'currency', currency,
  'unit_price_usd', CAST(abs(price) AS VARCHAR), 'line_total_usd', CAST(price AS VARCHAR),
  'order_status', order_status, 'raw_id', raw_id)"""

# --- upserts -----------------------------------------------------------------------------------

TWO_LOADS = f"""rows AS (
  SELECT {CHANNEL} AS source_platform, CAST(l_orderkey AS VARCHAR) AS platform_order_id,
    CAST(l_linenumber AS VARCHAR) AS platform_line_id,
    CASE WHEN l_returnflag <> 'A' THEN {cleaned(dressed(CHANNEL))} END AS platform_sku,
    {QTY} AS quantity, CAST({PRICE} AS DOUBLE) AS unit_price_local,
    CAST({PRICE} * {QTY} AS DOUBLE) AS line_total_local, l_returnflag AS order_status,
    l_linestatus, {RAW_ID} AS raw_id FROM {LINES}),
loads AS (SELECT * FROM rows QUALIFY row_number() OVER (
  PARTITION BY {KEY}, l_linestatus ORDER BY raw_id DESC) = 1)"""
UPSERTED = f"""WITH {TWO_LOADS} SELECT {KEY}, platform_sku, CAST(quantity AS BIGINT) AS quantity,
  unit_price_local, line_total_local, order_status FROM loads
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY l_linestatus DESC) = 1"""

EIGHTH = """CAST(CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 4) // 8 * CAST(0.01 AS DECIMAL(4,2))
  AS DECIMAL(12,2)) AS VARCHAR)"""
FACT_COLUMNS = f"""{KEY}, CAST(platform_id AS BIGINT) AS platform_id,
  CASE WHEN product_id IS NULL THEN 0 ELSE 1 END AS product_id, CAST(date_id AS VARCHAR) AS date_id, platform_sku,
  sku_canonical, CAST(quantity AS BIGINT) AS quantity, {doubles("unit_price_local", "line_total_local")}, currency,
  {doubles("unit_price_usd", "line_total_usd")}, order_status FROM facts"""

EVENT_ROWS = "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value FROM events"

QUERIES: dict[str, str] = {
    "revenue_monthly": f"WITH {LINE_STAGING}, {FACTS} {REVENUE}",
    "revenue_monthly_many_products": f"WITH {LINE_STAGING}, {FACTS} {REVENUE}",
    "sales_wide": f"""WITH {LINE_STAGING}, {FACTS}
      SELECT {stamp("order_dt_utc")} AS order_dt_utc, CAST(date_id AS VARCHAR) AS date_id,
        CAST(year(date_id) AS BIGINT) AS year, CAST(quarter(date_id) AS BIGINT) AS quarter,
        CAST(month(date_id) AS BIGINT) AS month, {MONTHS}[month(date_id)] AS month_name,
        {WEEKDAYS}[isodow(date_id)] AS day_name, isodow(date_id) >= 6 AS is_weekend,
        source_platform AS platform_code, platform_name, platform_type, sku_canonical,
        canonical_name AS product_name, category, platform_order_id, platform_line_id,
        platform_sku, CAST(quantity AS BIGINT) AS quantity, {doubles(*AMOUNTS)}, currency,
        order_status, customer_email FROM facts""",
    "top_runs": f"""SELECT o_orderkey AS run_id, {stamp("o_orderdate")} AS started_at,
      CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status
      FROM orders ORDER BY o_orderkey DESC LIMIT 10""",
    "clean_sku_text": f"""SELECT {LINE_ID}, {cleaned(f'''CASE WHEN l_returnflag <> 'R'
      AND l_linestatus = 'F' THEN '  ' ELSE {dressed("'shopify'")} END''')} AS sku FROM lineitem""",
    "parse_money_dot": f"""WITH t AS (SELECT *, {thousands(f"{PRICE} * {QTY}")} AS n FROM lineitem),
      s AS (SELECT *, CASE l_linenumber % 8 WHEN 0 THEN '$' || n WHEN 1 THEN 'USD ' || n
        WHEN 2 THEN ' ' || n || ' ' WHEN 3 THEN 'S/. ' || n WHEN 4 THEN '(' || n || ')'
        WHEN 5 THEN l_returnflag WHEN 6 THEN 'xyz' || l_partkey ELSE '-' || n END AS x FROM t)
      SELECT {LINE_ID}, CAST({money("x")} AS DOUBLE) AS amount FROM s""",
    "parse_money_comma": f"""WITH t AS (
        SELECT *, translate({thousands(f"{PRICE} * {QTY}")}, ',.', '.,') AS n FROM lineitem)
      SELECT {LINE_ID}, CAST(replace(replace(n, '.', ''), ',', '.') AS DOUBLE) AS amount FROM t""",
    "parse_whole": f"""WITH t AS (SELECT *, CASE l_linenumber % 6 WHEN 0 THEN CAST({QTY} AS VARCHAR)
        WHEN 1 THEN ' ' || {QTY} || ' ' WHEN 2 THEN {QTY} || '.0' WHEN 3 THEN {QTY} || '.5'
        WHEN 4 THEN {QTY} || ' pcs' ELSE '' END AS x FROM lineitem),
      n AS (SELECT *, TRY_CAST(trim(x) AS DOUBLE) AS v FROM t)
      SELECT {LINE_ID}, CASE WHEN v = floor(v) THEN v END AS quantity FROM n""",
    "iso_instants": """WITH t AS (SELECT event_id, date_trunc('second', ts) AS s, ts FROM events)
      SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(s + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S')
        WHEN 2 THEN strftime(s - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') || '.25'
        WHEN 5 THEN NULL ELSE strftime(s, '%Y-%m-%d %H:%M:%S') END AS instant FROM t""",
    "lima_instants": f"""SELECT event_id, CASE WHEN event_type <> 'error'
        THEN {stamp("ts + INTERVAL 5 HOUR")} END AS from_text,
      CAST(ts + INTERVAL 5 HOUR AS VARCHAR) AS from_time FROM events""",
    "new_york_instants": f"""WITH t AS (SELECT *, l_shipdate
          + to_minutes(30 * ((l_partkey % 24) * 2 + l_suppkey % 2)) AS wall FROM lineitem),
        y AS (SELECT *, make_date(year(wall), 4, 1) AS apr, make_date(year(wall), 10, 31) AS oct FROM t),
        c AS (SELECT *, CAST(apr + CAST((7 - isodow(apr)) % 7 AS INT) AS TIMESTAMP) AS spring,
          CAST(oct - CAST(isodow(oct) % 7 AS INT) AS TIMESTAMP) AS fall FROM y)
      SELECT {LINE_ID}, CASE
        WHEN wall >= spring + INTERVAL 2 HOUR AND wall < spring + INTERVAL 3 HOUR THEN NULL
        WHEN wall >= fall + INTERVAL 1 HOUR AND wall < fall + INTERVAL 2 HOUR THEN NULL
        WHEN wall >= spring AND wall < fall + INTERVAL 1 HOUR AND wall >= spring + INTERVAL 3 HOUR
          THEN {stamp("wall + INTERVAL 4 HOUR")}
        ELSE {stamp("wall + INTERVAL 5 HOUR")} END AS instant FROM c""",
    "dmy_instants": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2
      THEN {stamp("o_orderdate + INTERVAL 5 HOUR")} END AS instant FROM orders""",
    "calendar_of_shipping": f"""SELECT {LINE_ID}, {calendar_parts("CAST(l_shipdate AS DATE)")}
      FROM lineitem""",
    "rows_as_json": """SELECT event_id, json_object('event_id', event_id, 'ts', CAST(ts AS VARCHAR),
        'user_id', user_id, 'event_type', event_type,
        'value', CASE WHEN event_type <> 'error' THEN value END,
        'props', CASE WHEN event_type <> 'click' THEN props END) AS payload FROM events""",
    "staging_types": f"""SELECT CAST(l_orderkey AS VARCHAR) AS platform_order_id,
      CAST(l_linenumber AS VARCHAR) AS platform_line_id, CAST({RAW_ID} AS BIGINT) AS raw_id,
      {stamp("l_shipdate")} AS order_dt_utc,
      CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS quantity,
      CAST(CAST({PRICE} || '125' AS DECIMAL(12,4)) AS DOUBLE) AS unit_price_local,
      CASE WHEN l_linestatus <> 'F' THEN CAST({PRICE} AS DOUBLE) END AS line_total_local,
      l_returnflag AS currency FROM lineitem""",
    "fx_attach": f"""WITH {FX}, {CLEAN_LINES}, rated AS (SELECT * REPLACE (
        CASE WHEN raw_status = 'P' THEN 'EUR' ELSE currency END AS currency) FROM cleaned)
      SELECT {KEY}, CAST(raw_id AS BIGINT) AS raw_id, r.currency,
        CAST(round(unit_price_local * coalesce(fx.rate, latest.rate), 4) AS DOUBLE) AS unit_price_usd,
        CAST(round(line_total_local * coalesce(fx.rate, latest.rate), 4) AS DOUBLE) AS line_total_usd
      FROM rated r LEFT JOIN fx ON fx.currency = r.currency AND fx.rate_date = CAST(order_dt_utc AS DATE)
      LEFT JOIN latest ON latest.currency = r.currency""",
    "fx_latest": f"WITH {FX} SELECT currency, CAST(rate AS DOUBLE) AS latest_rate FROM latest",
    "status_map": f"""WITH {STATUSES}, o AS (SELECT o_orderkey, {CHANNEL} AS source_platform,
        {raw_status(CHANNEL)} AS raw_status FROM orders)
      SELECT o_orderkey, source_platform, raw_status,
        coalesce(canonical_status, 'unknown') AS order_status
      FROM o LEFT JOIN statuses USING (source_platform, raw_status)""",
    "canonical_sku": f"""WITH {MAPPED} SELECT {KEY}, CAST(raw_id AS BIGINT) AS raw_id, platform_sku,
      sku_canonical, canonical_product_name, category FROM mapped""",
    "unmapped_sku_report": f"""WITH {MAPPED} SELECT source_platform, platform_sku,
      count(*) AS occurrences FROM mapped
      WHERE sku_canonical IS NULL AND platform_sku IS NOT NULL GROUP BY ALL""",
    "unmapped_sku_totals": f"""WITH {MAPPED}, c AS (SELECT source_platform, platform_sku,
        count(*) AS n FROM mapped WHERE sku_canonical IS NULL GROUP BY ALL)
      SELECT count(*) AS unmapped_pairs, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_covered FROM c""",
    "sku_mapping_coverage": f"""WITH {MAPPED} SELECT count(*) AS total_rows,
      count(sku_canonical) AS matched, count(*) - count(sku_canonical) AS unmatched FROM mapped""",
    "sku_mapping_conflicts": """SELECT p_type AS source_platform, lower(p_name) AS sku_key,
      count(*) AS mapping_rows, min(p_brand) AS sku_canonical FROM part
      GROUP BY 1, 2 HAVING count(*) > 1""",
    "dedupe_keep_last": dedupe("last"),
    "dedupe_keep_first": dedupe("first"),
    "drop_incomplete_lines": f"""WITH {CLEAN_LINES}, newest AS (SELECT * FROM cleaned
        QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY raw_id DESC) = 1)
      SELECT {KEY}, CAST(raw_id AS BIGINT) AS raw_id, CAST(quantity AS BIGINT) AS quantity,
        {stamp("order_dt_utc")} AS order_dt_utc FROM newest WHERE quantity >= 0 AND raw_status <> 'P'""",
    "line_positions": f"""WITH n AS (SELECT *, {RAW_ID} AS raw_id, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY {RAW_ID}) AS line_pos FROM lineitem)
      SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(raw_id AS BIGINT) AS raw_id,
        line_pos, l_orderkey || '-' || line_pos AS platform_line_id FROM n""",
    "line_positions_two_batches": f"""WITH l AS (SELECT l_orderkey, l_linenumber,
        'S' || (l_partkey % 3) AS sku, {RAW_ID} AS raw_id,
        CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS batch_id FROM lineitem),
      landed AS (SELECT * FROM l UNION ALL
        SELECT l_orderkey, l_linenumber, sku, raw_id + 1099511627776, 3 FROM l WHERE batch_id = 1),
      n AS (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, batch_id, sku ORDER BY raw_id) AS nth FROM landed),
      f AS (SELECT *, min(batch_id * 4398046511104 + raw_id) OVER (
        PARTITION BY l_orderkey, sku, nth) AS appeared FROM n)
      SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(raw_id AS BIGINT) AS raw_id,
        CAST(batch_id AS BIGINT) AS batch_id, sku,
        dense_rank() OVER (PARTITION BY l_orderkey ORDER BY appeared) AS line_pos FROM f""",
    "surrogate_keys": """SELECT count(*) AS row_count, count(*) AS id_count, true AS above_start
      FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "order_json_explode": f"""WITH lines AS ({extracted("shopify", False)})
      SELECT platform_order_id, platform_line_id,
        strftime(order_dt_utc - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS order_dt_raw,
        sku AS platform_sku, product_name, CAST(quantity AS VARCHAR) AS quantity,
        CAST(CAST(unit_price_local AS DECIMAL(12,2)) AS VARCHAR) AS unit_price_local,
        CASE WHEN element = 1 THEN '0.00' ELSE CAST(CAST(discount_local AS DECIMAL(12,4)) AS VARCHAR)
          END AS discount_local,
        CAST(CAST(line_total_local AS DECIMAL(12,2)) AS VARCHAR) AS line_total_local,
        currency, raw_status, customer_email, CAST(element + 1 AS BIGINT) AS element,
        CAST(NULL AS DOUBLE) AS tax_local
      FROM lines JOIN (
        SELECT {RAW_ID} AS r, CAST(l_orderkey AS VARCHAR) AS o, CAST(l_linenumber AS VARCHAR) AS l,
          {dressed("'shopify'")} AS sku FROM lineitem
        UNION ALL SELECT {RAW_ID}, CAST(l_orderkey AS VARCHAR), CAST(l_linenumber + 100 AS VARCHAR), 'GIFT'
        FROM lineitem WHERE l_returnflag = 'N')
      ON r = raw_id AND o = platform_order_id AND l = platform_line_id""",
    "order_json_posexplode": f"""WITH lines AS ({extracted("mercadolibre", False)})
      SELECT platform_order_id, platform_line_id,
        strftime(order_dt_utc - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000-05:00' AS order_dt_raw,
        ' ' || platform_sku AS platform_sku, product_name, CAST(quantity AS DOUBLE) AS quantity,
        {doubles("unit_price_local", "discount_local", "line_total_local")}, currency, raw_status,
        customer_email FROM lines""",
    "json_missing_keys": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN NULL
      ELSE substr(o_orderpriority, 1, 1) END AS currency, o_orderstatus = 'F' AS missing FROM orders""",
    **{f"normalize_{channel}": normalized(channel) for channel in CHANNELS},
    "all_channels_staging": f"WITH {ALL_STAGING} SELECT {STAGING_RESULT} FROM staging",
    "fact_load": f"""WITH {ALL_STAGING}, {FACTS} SELECT CAST(platform_id AS BIGINT) AS platform_id,
      CAST(product_id AS BIGINT) AS product_id, CAST(date_id AS VARCHAR) AS date_id, {KEY},
      platform_sku, sku_canonical, {stamp("order_dt_utc")} AS order_dt_utc,
      CAST(quantity AS BIGINT) AS quantity,
      {doubles("unit_price_local", "discount_local", "tax_local", "line_total_local")}, currency,
      {doubles("unit_price_usd", "line_total_usd")}, order_status, customer_email FROM facts""",
    "extraction_counts": f"""WITH {CLEAN_LINES}, newest AS (SELECT * FROM cleaned
        QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY raw_id DESC) = 1)
      SELECT (SELECT count(*) FROM cleaned) AS extracted,
        (SELECT count(*) FROM cleaned) - count(*) AS duplicates_dropped,
        count(*) FILTER (quantity < 0) AS incomplete_dropped,
        count(*) FILTER (quantity >= 0) AS staged FROM newest""",
    "validation_summary": f"""WITH {JUDGED} SELECT count(*) AS total,
      count(*) - count(reason) AS valid, count(reason) AS rejected FROM judged""",
    "rejected_lines": f"""WITH {JUDGED} SELECT source_platform AS source_name,
      CAST(raw_id AS BIGINT) AS raw_id, reason, CAST({PAYLOAD} AS VARCHAR) AS payload
      FROM judged WHERE reason IS NOT NULL""",
    "valid_lines": f"""WITH {JUDGED} SELECT {KEY}, CAST(raw_id AS BIGINT) AS raw_id, currency,
      CAST(price AS DOUBLE) AS unit_price_local, CAST(quantity AS BIGINT) AS quantity
      FROM judged WHERE reason IS NULL""",
    "validation_of_text": f"""WITH {FAULTY}, judged AS (SELECT CASE WHEN {FUTURE} THEN {SAID_FUTURE}
        WHEN order_status = 'refunded' THEN 'quantity: Input should be a valid integer'
        WHEN quantity = 0 THEN 'quantity: Value error, quantity cannot be zero'
        WHEN price < 0 THEN {SAID_PRICE}
        WHEN currency = 'usd' THEN 'discount_local: Input should be a finite number'
        WHEN currency = ' PEN ' THEN 'tax_local: Input should be a valid decimal'
        {CURRENCY_CASES} {STATUS_CASE} ELSE 'valid' END AS reason FROM faulty)
      SELECT reason, count(*) AS row_count FROM judged GROUP BY reason""",
    "fact_upsert": UPSERTED,
    "fact_upsert_stored": UPSERTED,
    "reference_upsert": """SELECT 'C' || p_partkey AS sku_canonical,
      CASE WHEN p_size >= 20 THEN upper(p_name) ELSE p_name END AS product_name, p_type AS category,
      CAST(CAST(p_retailprice AS DECIMAL(12,2)) + CASE WHEN p_size >= 20 THEN 1 ELSE 0 END AS DOUBLE)
        AS base_price_usd FROM part""",
    "insert_if_absent": """WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
      s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
      SELECT CAST(d AS VARCHAR) AS date_id, 'order' AS origin FROM o
      UNION ALL SELECT CAST(d AS VARCHAR), 'shipping' FROM s WHERE d NOT IN (SELECT d FROM o)""",
    "checkpoint_accumulate": """SELECT event_type AS source_name,
      CAST(max(ts) AS VARCHAR) AS last_watermark, count(*) AS rows_ingested
      FROM events GROUP BY event_type""",
    "unmapped_accumulate": """SELECT 'pos' AS source_platform,
      CASE WHEN l_returnflag = 'R' THEN 'pos ' ELSE 'POS ' END || l_partkey AS platform_sku,
      count(*) AS occurrences, min(l_linestatus) AS first_seen
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#25' GROUP BY 1, 2""",
    "dim_date": f"""WITH b AS (SELECT date_trunc('year', min(o_orderdate)) AS lo,
        date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR AS hi FROM orders),
      d AS (SELECT CAST(unnest(range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY))
        AS DATE) AS date_id FROM b)
      SELECT CAST(date_id AS VARCHAR) AS date_id, {calendar_parts("date_id")} FROM d""",
    "dim_product": f"""WITH {CATALOG} SELECT sku_canonical, product_name, category,
      CAST(base_price_usd AS DOUBLE) AS base_price_usd, CAST(product_id AS BIGINT) AS product_id
      FROM products""",
    "catalog_unpivot": f"""WITH {CATALOG} SELECT sku_canonical, product_name, category,
      CAST(base_price_usd AS DOUBLE) AS base_price_usd, source_platform, platform_sku FROM mapping""",
    "outside_calendar": f"""SELECT {LINE_ID}, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date_id
      FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN (
        SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "high_watermark_batch": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, value FROM events
      WHERE ts > TIMESTAMP '2024-01-15'""",
    "newest_time": "SELECT CAST(max(ts) + INTERVAL 5 HOUR AS VARCHAR) AS last_watermark FROM events",
    "incremental_ingest": EVENT_ROWS,
    "incremental_upsert": f"""{EVENT_ROWS} QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "tsv_source": f"""SELECT CAST(l_orderkey AS VARCHAR) AS amazon_order_id,
      {WALL} || '-05:00' AS purchase_date, {raw_status("'amazon'")} AS order_status,
      {dressed("'amazon'")} AS sku, CAST({QTY} AS VARCHAR) AS quantity_purchased,
      CASE WHEN l_linestatus = 'F' THEN 'USD' END AS currency, {thousands(PRICE)} AS item_price,
      {thousands(f"CAST({PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2))")} AS item_tax,
      {EMAIL} AS buyer_email, CAST(NULL AS VARCHAR) AS ship_city, 'MRC' || l_orderkey AS merchant_order_id,
      {WALL} || '-05:00' AS last_updated_date, 'Part ' || l_partkey AS product_name,
      '0.00' AS shipping_price, CAST(NULL AS VARCHAR) AS ship_state FROM {BUYERS}""",
    "workbook_source": f"""SELECT CAST(l_orderkey AS VARCHAR) AS n_orden,
      strftime(o_orderdate, '%d/%m/%Y') AS fecha, {raw_status("'tiendanube'")} AS estado_pago,
      'Enviado' AS estado_envio, {dressed("'tiendanube'")} AS sku, 'Part ' || l_partkey AS producto,
      CAST({QTY} AS VARCHAR) AS cantidad, 'S/ ' || {thousands(PRICE)} AS precio_unit,
      {thousands(f"CAST({DISCOUNT} AS DECIMAL(14,2))")} AS descuento,
      {thousands(f"{PRICE} * {QTY}")} AS subtotal,
      CASE WHEN l_linestatus = 'F' THEN 'PEN' END AS moneda FROM {BUYERS}""",
    "wrapped_json_source": f"""SELECT o_orderkey AS order_id,
      strftime(o_orderdate, '%Y-%m-%d') || 'T21:15:00.000-05:00' AS date_created,
      {raw_status("'mercadolibre'")} AS status,
      CASE WHEN o_orderstatus <> 'P' THEN 'b' || o_custkey || '@example.com' END AS email,
      ' mla ' || (o_custkey + 1) AS first_sku FROM orders""",
    "raw_landing": f"""WITH r AS (SELECT {QTY} AS q, CAST({PRICE} * {QTY} AS DECIMAL(18,2)) AS t
        FROM {BUYERS})
      SELECT count(*) + count(*) FILTER (q < 0) AS row_count,
        count(*) + count(*) FILTER (q < 0) AS id_count, true AS ids_grow,
        count(*) FILTER (q < 0) AS second_batch,
        CAST(sum(t) + sum(t) FILTER (q < 0) AS DOUBLE) AS total FROM r""",
    "daily_job_revenue": f"WITH {ALL_STAGING}, {FACTS} {REVENUE}",
    "raw_ids_per_row": f"""WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS venta_id, {WALL} AS wall, {QTY} AS q
        FROM {LINES}
        QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber ORDER BY {RAW_ID} DESC) = 1)
      SELECT venta_id, 1 AS batch_id, row_number() OVER (ORDER BY wall, venta_id) AS raw_id FROM r
      UNION ALL
      SELECT venta_id, 2, (SELECT count(*) FROM r) + row_number() OVER (ORDER BY wall, venta_id) FROM r WHERE q < 0""",
    "fact_upsert_ids": f"""WITH {TWO_LOADS}, keyed AS (SELECT *,
        CAST('0x' || substr(md5({KEY.replace(', ', " || chr(31) || ")}), 1, 8) AS BIGINT) % 16 AS slice FROM loads),
      one AS (SELECT {KEY}, row_number() OVER (ORDER BY slice, {KEY}) AS sale_id FROM keyed WHERE l_linestatus = 'F'),
      two AS (SELECT {KEY}, (SELECT count(*) FROM one) + row_number() OVER (ORDER BY slice, {KEY}) AS sale_id
        FROM keyed WHERE l_linestatus = 'O' AND ({KEY}) NOT IN (SELECT ({KEY}) FROM one))
      SELECT * FROM one UNION ALL SELECT * FROM two""",
    "reject_sink_two_runs": f"""WITH {JUDGED} SELECT source_platform AS source_name, CAST(raw_id AS BIGINT) AS raw_id,
        platform_line_id, reason, CASE WHEN raw_id % 2 = 0 THEN 1 ELSE 2 END AS first_run_id, 2 AS last_run_id
      FROM judged WHERE reason IS NOT NULL GROUP BY ALL""",
    "file_progress": """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 1 THEN 2 ELSE 4 END AS batch_id,
      1 AS times, (SELECT count(*) FROM orders) AS ingested FROM orders""",
    "wrapped_json_split": f"""SELECT o_orderkey AS order_id, '{{"id":' || o_orderkey || ',"date_created":"'
        || strftime(o_orderdate, '%Y-%m-%d') || 'T21:15:00.000-05:00","status":"' || {raw_status("'mercadolibre'")}
        || '","buyer":' || CASE WHEN o_orderstatus <> 'P' THEN '{{"email":"b' || o_custkey || '@example.com"}}' ELSE 'null' END
        || ',"order_items":[' || array_to_string(['{{"item":{{"seller_sku":" mla ' || (o_custkey + i) || '","title":"Part '
          || (o_custkey + i) || '"}},"quantity":' || i || ',"unit_price":' || {EIGHTH} || '}}'
          FOR i IN range(1, o_orderkey % 4 + 2)], ',') || ']}}' AS payload
      FROM orders""",
    "daily_job_two_days": f"""WITH {ALL_STAGING}, {FACTS} SELECT {FACT_COLUMNS}""",
}
DIGITS = "repeat('7', CAST(l_linenumber + 13 AS INT)) || '.' || substr(lpad(CAST(l_partkey AS VARCHAR), 3, '0'), 1, 3)"
QUERIES["huge_amounts"] = f"""WITH t AS (SELECT *, {DIGITS} AS digits FROM lineitem)
  SELECT {LINE_ID}, CASE WHEN l_linestatus = 'F' AND l_linenumber <= 5 THEN
      CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || digits || '0000000' END AS amount,
    l_linestatus = 'F' AND l_linenumber > 5 AS beyond FROM t"""
QUERIES["refused_lines"] = f"""WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS platform_order_id,
    CASE l_orderkey % 5 WHEN 0 THEN 'unit_price_local: out of range' WHEN 1 THEN 'unit_price_local: out of range'
      WHEN 2 THEN 'tax_local: out of range' ELSE 'line_total_local: out of range' END AS refusal
  FROM {BUYERS} WHERE l_orderkey % 5 < 4)
  SELECT platform_order_id, refusal, count(*) AS row_count FROM r GROUP BY ALL"""
QUERIES["workbook_drop"] = QUERIES["workbook_source"].replace("SELECT ", f"SELECT c_name AS cliente, {EMAIL} AS email, ", 1)
QUERIES["coverage_report_job"] = f"""WITH {LINE_STAGING}, {FACTS},
  u AS (SELECT source_platform AS source_name, platform_sku, 2 * count(*) AS occurrences FROM facts
    WHERE sku_canonical IS NULL AND platform_sku IS NOT NULL GROUP BY ALL)
  SELECT u.*, false AS resolved, (SELECT count(*) FROM facts) AS total_rows,
    (SELECT count(sku_canonical) FROM facts) AS matched,
    (SELECT count(*) - count(sku_canonical) FROM facts) AS unmatched FROM u"""
QUERIES["run_audit_rows"] = """WITH n AS (SELECT count(DISTINCT l_orderkey * 10 + l_linenumber) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '5-LOW')
  SELECT 1 AS run_id, 'success' AS status, n AS till_rows, n AS facts, false AS has_error, true AS finished FROM n
  UNION ALL SELECT 2, 'failed', NULL, NULL, true, true"""
QUERIES["late_rows_left_out"] = f"{EVENT_ROWS} WHERE ts > TIMESTAMP '2024-01-16 12:00:00'"
QUERIES["empty_load"] = f"""WITH {TWO_LOADS} SELECT {KEY}, platform_sku, CAST(quantity AS BIGINT) AS quantity,
  unit_price_local, line_total_local, order_status FROM loads WHERE l_linestatus = 'F'"""
QUERIES["long_reasons"] = f"""WITH {FAULTY}, r AS (SELECT *, left('order_status: Value error, unknown order_status ' || chr(39)
  || trim(repeat('no status ', CAST(platform_line_id AS INT) + 42)) || chr(39), 500) AS reason FROM faulty)
  SELECT {KEY}, CAST(raw_id AS BIGINT) AS raw_id, reason, length(reason) AS size FROM r"""
QUERIES["tsv_two_headers"] = QUERIES["tsv_source"]
QUERIES["stage_counts_observed"] = QUERIES["extraction_counts"]
