"""DuckDB oracle SQL per registered query (tables: the parquet views)."""

from __future__ import annotations

from oracle import model

AS_OF = "DATE '2002-01-01'"
MIN_DATE = "DATE '1900-01-01'"

# CTE name -> (sql, dependencies)
_CTES: dict[str, tuple[str, list[str]]] = {
    "m_orders": (model.M_ORDERS, []),
    "m_order_items": (model.M_ORDER_ITEMS, []),
    "m_categories": (model.M_CATEGORIES, []),
    "m_brands": (model.M_BRANDS, []),
    "m_products": (model.M_PRODUCTS, ["m_categories"]),
    "m_customers": (model.M_CUSTOMERS, []),
    "m_stores": (model.M_STORES, []),
    "m_staffs": (model.M_STAFFS, []),
}


def cte(name: str, deps: list[str]):
    def register(sql: str) -> str:
        _CTES[name] = (sql, deps)
        return sql
    return register


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(_CTES[n][0].strip() for n in order) + "\n" + body


def first_per_key(source: str, keys: list[str], order: list[str], cols: list[str]) -> str:
    """Deterministic first row per key: smallest ``order`` columns, NULLs first."""
    ob = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {ob}) AS rn__ FROM {source}) q WHERE rn__ = 1")


# ---------------------------------------------------------------- gold ----
cte("g_dim_date", ["m_orders"])(f"""
g_dim_date AS (
  SELECT full_date,
         CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(year(full_date) AS INTEGER) AS year,
         CAST(month(full_date) AS INTEGER) AS month,
         CAST(day(full_date) AS INTEGER) AS day,
         CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
         isodow(full_date) >= 6 AS is_weekend,
         monthname(full_date) AS month_name,
         dayname(full_date) AS day_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
         day(full_date) = 1 AS is_month_start,
         full_date = last_day(full_date) AS is_month_end
  FROM (SELECT DISTINCT order_date AS full_date FROM m_orders
        WHERE order_date > {MIN_DATE} - INTERVAL 7 DAY) d
)""")

_CUST = ["customer_id", "first_name", "last_name", "email", "city", "state"]
cte("g_dim_customer", ["m_customers"])(f"""
g_dim_customer AS (
  SELECT *, customer_id AS customer_key FROM (
    {first_per_key(f"(SELECT DISTINCT {', '.join(_CUST)} FROM m_customers)", ["customer_id"], _CUST[1:], _CUST)}
  ) x
)""")

_STAFF = ["staff_id", "store_id", "first_name", "last_name", "active"]
cte("g_dim_staff", ["m_staffs"])(f"""
g_dim_staff AS (
  SELECT *, staff_id AS staff_key FROM (
    {first_per_key(f"(SELECT DISTINCT {', '.join(_STAFF)} FROM m_staffs)", ["staff_id"], _STAFF[1:], _STAFF)}
  ) x
)""")

_STORE = ["store_id", "store_name"]
cte("g_dim_store", ["m_stores"])(f"""
g_dim_store AS (
  SELECT *, store_id AS store_key FROM (
    {first_per_key(f"(SELECT DISTINCT {', '.join(_STORE)} FROM m_stores)", ["store_id"], _STORE[1:], _STORE)}
  ) x
)""")

_PROD = ["product_id", "product_name", "model_year", "list_price", "category_id",
         "category_name", "brand_id", "brand_name"]
cte("g_dim_product", ["m_products", "m_categories", "m_brands"])(f"""
g_dim_product AS (
  SELECT *, product_id AS product_key FROM (
    {first_per_key('''(SELECT DISTINCT p.product_id, p.product_name, p.model_year, p.list_price,
              p.category_id, c.category_name, p.brand_id, b.brand_name
       FROM m_products p
       JOIN m_categories c ON p.category_id = c.category_id
       LEFT JOIN m_brands b ON p.brand_id = b.brand_id
       WHERE c.category_id IS NOT NULL)''', ["product_id"], _PROD[1:], _PROD)}
  ) x
)""")

ORDERS_DERIVED = f"""
  CAST(datediff('day', o.order_date, o.shipped_date) AS INTEGER) AS days_to_ship,
  CAST(datediff('day', o.order_date, o.required_date) AS INTEGER) AS promised_days,
  CASE WHEN o.shipped_date IS NOT NULL THEN 1 ELSE 0 END AS is_shipped,
  CASE WHEN o.shipped_date > o.required_date THEN 1 ELSE 0 END AS is_late,
  CASE WHEN o.shipped_date <= o.required_date THEN 1 ELSE 0 END AS sla_met,
  CAST(datediff('day', o.order_date, COALESCE(o.shipped_date, {AS_OF})) AS INTEGER) AS days_open,
  CASE WHEN o.shipped_date IS NOT NULL
       THEN CAST(datediff('day', o.required_date, o.shipped_date) AS INTEGER) END AS delay_days,
  CASE WHEN o.shipped_date IS NULL
       THEN CAST(datediff('day', o.required_date, {AS_OF}) AS INTEGER) ELSE 0 END AS open_delay_days"""

FACT_REST = ["order_date", "date_key", "customer_name", "store_name", "staff_key", "staff_name",
             "quantity", "unit_price", "total_item_amount", "discount", "gross_amount",
             "net_amount", "days_to_ship", "promised_days", "is_shipped", "is_late", "sla_met",
             "days_open", "delay_days", "open_delay_days"]
FACT_COLS = ["order_id", "order_date", "product_id", "date_key", "customer_key", "customer_name",
             "store_key", "store_name", "staff_key", "staff_name", "quantity", "unit_price",
             "total_item_amount", "discount", "gross_amount", "net_amount", "days_to_ship",
             "promised_days", "is_shipped", "is_late", "sla_met", "days_open", "delay_days",
             "open_delay_days"]


def fact_sql(last_date: str = MIN_DATE) -> str:
    """By definition: a head per order with everything that depends on the order
    alone (each name looked up in its dimension), then the lines under their heads.
    An order of an unknown customer or day has no head."""
    def lookup(value: str, table: str, key: str) -> str:
        return f"(SELECT max({value}) FROM {table} AS x WHERE {key})"

    head = f"""
    SELECT o.order_id, o.order_date, {lookup('x.date_key', 'g_dim_date', 'x.full_date = o.order_date')} AS date_key,
           CAST(o.customer_id AS VARCHAR) AS customer_key,
           {lookup("x.first_name || ' ' || x.last_name", 'g_dim_customer', 'x.customer_key = o.customer_id')} AS customer_name,
           {lookup('CAST(x.store_key AS VARCHAR)', 'g_dim_store', 'x.store_key = o.store_id')} AS store_key,
           {lookup('x.store_name', 'g_dim_store', 'x.store_key = o.store_id')} AS store_name,
           {lookup('x.staff_key', 'g_dim_staff', 'x.staff_key = o.staff_id')} AS staff_key,
           {lookup("x.first_name || ' ' || x.last_name", 'g_dim_staff', 'x.staff_key = o.staff_id')} AS staff_name,
           {ORDERS_DERIVED}
    FROM m_orders AS o
    WHERE o.order_date >= {last_date} - INTERVAL 7 DAY
      AND o.customer_id IN (SELECT customer_key FROM g_dim_customer)
      AND o.order_date IN (SELECT full_date FROM g_dim_date)"""
    return f"""
  SELECT * EXCLUDE (item_id, list_price), list_price AS unit_price, quantity * list_price AS total_item_amount,
         quantity * list_price AS gross_amount, quantity * list_price * (1 - discount) AS net_amount
  FROM ({head}) AS head JOIN m_order_items USING (order_id)"""


_GOLD_DEPS = ["m_order_items", "m_orders", "g_dim_date", "g_dim_customer", "g_dim_store",
              "g_dim_staff"]
cte("g_fact", _GOLD_DEPS)(f"""
g_fact AS (
  {first_per_key("(" + fact_sql() + ")", ["order_id", "product_id", "customer_key", "store_key"], FACT_REST, FACT_COLS)}
)""")


def _monthly(select: str) -> str:
    return with_ctes(f"""
SELECT strftime(d.full_date, '%Y-%m') AS year_month, {select}
FROM g_fact f JOIN g_dim_date d ON f.date_key = d.date_key
WHERE f.is_shipped <> 0
GROUP BY year_month
ORDER BY year_month""", "g_fact", "g_dim_date")


ORACLE: dict[str, str] = {
    "dim_date": with_ctes("SELECT * FROM g_dim_date", "g_dim_date"),
    "dim_customer": with_ctes("SELECT * FROM g_dim_customer", "g_dim_customer"),
    "dim_staff": with_ctes("SELECT * FROM g_dim_staff", "g_dim_staff"),
    "dim_store": with_ctes("SELECT * FROM g_dim_store", "g_dim_store"),
    "dim_product": with_ctes("SELECT * FROM g_dim_product", "g_dim_product"),
    "fact_sales": with_ctes("SELECT * FROM g_fact", "g_fact"),
    "agg_monthly_billing": _monthly(
        "round(SUM(f.gross_amount), 2) AS total_billing, COUNT(*) AS total_orders"),
    "agg_sla": _monthly("""COUNT(*) AS total_orders,
       CAST(SUM(CASE WHEN f.sla_met <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS orders_on_time,
       AVG(CASE WHEN f.sla_met <> 0 THEN 1 ELSE 0 END) AS sla_rate,
       AVG(f.delay_days) AS avg_delay_days"""),
    "agg_delay": _monthly("""COUNT(*) AS total_orders,
       CAST(SUM(CASE WHEN f.is_late <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_late_orders,
       AVG(CASE WHEN f.is_late <> 0 THEN 1 ELSE 0 END) AS late_rate,
       AVG(CASE WHEN f.is_late <> 0 THEN f.delay_days END) AS avg_delay_days"""),
    "agg_monthly_average_ticket": _monthly("""round(SUM(f.gross_amount), 2) AS total_revenue,
       COUNT(*) AS total_orders,
       round(SUM(f.gross_amount) / COUNT(*), 6) AS avg_ticket"""),
    "agg_monthly_discount": _monthly("""round(SUM(f.gross_amount), 2) AS total_gross,
       round(SUM(f.discount * f.gross_amount), 4) AS total_discount_value,
       round(SUM(f.discount * f.gross_amount) / NULLIF(SUM(f.gross_amount), 0), 10) AS discount_rate"""),
    "agg_top_products": with_ctes("""
SELECT p.product_id, p.product_name,
       CAST(SUM(f.quantity) AS BIGINT) AS total_quantity,
       round(SUM(f.gross_amount), 2) AS total_revenue,
       CAST(RANK() OVER (ORDER BY SUM(f.gross_amount) DESC) AS BIGINT) AS revenue_rank,
       round(SUM(f.gross_amount) / NULLIF(SUM(SUM(f.gross_amount)) OVER (), 0), 10) AS revenue_share
FROM g_fact f JOIN g_dim_product p ON f.product_id = p.product_id
WHERE f.is_shipped <> 0
GROUP BY p.product_id, p.product_name
ORDER BY total_revenue DESC""", "g_fact", "g_dim_product"),
}


# ---------------------------------------------------------- row operators --
# Plain letter -> its accented forms, and the spellings of "no value".
ACCENTS = {"A": "ÁÀÂÃÄÅ", "a": "áàâãäå", "E": "ÉÈÊË", "e": "éèêë", "I": "ÍÌÎÏ", "i": "íìîï", "O": "ÓÒÔÕÖ",
           "o": "óòôõö", "U": "ÚÙÛÜ", "u": "úùûü", "C": "Ç", "c": "ç", "N": "Ñ", "n": "ñ"}
NO_VALUE = ["", "na", "n/a", "null", "-"]


def clean_sql(x: str, collapse: str = "first") -> str:
    """Cleaned text by definition: no value, or each accented letter plain, white
    space (first run or all) one space, trimmed, lower case."""
    plain = f"CAST({x} AS VARCHAR)"
    for letter, accented in ACCENTS.items():
        plain = f"regexp_replace({plain}, '[{accented}]', '{letter}', 'g')"
    runs = f"regexp_replace({plain}, '\\s+', ' '{', ' + chr(39) + 'g' + chr(39) if collapse == 'all' else ''})"
    return f"CASE WHEN NOT list_contains({NO_VALUE}, trim(lower(CAST({x} AS VARCHAR)))) THEN lower(trim({runs})) END"


def row_hash_sql(cols: list[str], prefix: str = "") -> str:
    parts = ", ".join(f"COALESCE(CAST({prefix}{c} AS VARCHAR), '<<NULL>>')" for c in cols)
    return f"md5(concat_ws('||', {parts}))"


def merge_sql(target: str, source: str, keys: list[str], cols: list[str],
              hash_col: str | None, null_safe: bool) -> str:
    eq = " IS NOT DISTINCT FROM " if null_safe else " = "
    on = " AND ".join(f"t.{k}{eq}s.{k}" for k in keys)
    take = "s.hit__ IS NOT NULL"
    if hash_col:
        take += f" AND (t.hit__ IS NULL OR COALESCE(t.{hash_col} <> s.{hash_col}, false))"
    sel = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return (f"SELECT {sel} FROM (SELECT *, 1 AS hit__ FROM {target}) t "
            f"FULL OUTER JOIN (SELECT *, 1 AS hit__ FROM {source}) s ON {on}")


ORDER_COLS = ["order_id", "customer_id", "order_status", "order_date", "required_date",
              "shipped_date", "store_id", "staff_id"]
ORDER_KEYS = ["order_id", "customer_id", "store_id", "staff_id"]
ITEM_COLS = ["order_id", "item_id", "product_id", "quantity", "list_price", "discount"]
STAFF_COLS = ["staff_id", "store_id", "manager_id", "first_name", "last_name", "phone",
              "email", "active"]
EVENTS_CUT = "TIMESTAMP '2024-01-15 00:00:00'"
ORDERS_CUT = "DATE '1998-01-01'"
LAST_PROCESSED = "DATE '2001-06-01'"

cte("m_orders_c", [])(model.orders_as_of("m_orders_c", ORDERS_CUT))

_DQ_ITEMS = ("quantity > 0 AND list_price >= 0 AND discount BETWEEN 0 AND 0.05 "
             "AND order_id IS NOT NULL AND item_id IS NOT NULL AND product_id IS NOT NULL")

_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]


def latest_per_key(source: str, keys: list[str], order: list[str], cols: list[str]) -> str:
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {ob}) AS rn__ FROM {source}) q WHERE rn__ = 1")


_EV = ["user_id", "ts", "event_id", "event_type", "value"]
_ITEMS_TYPED = ("TRY_CAST(order_id AS INTEGER) AS order_id, TRY_CAST(item_id AS INTEGER) AS item_id, "
                "TRY_CAST(product_id AS INTEGER) AS product_id, "
                "TRY_CAST(quantity AS INTEGER) AS quantity, "
                "TRY_CAST(list_price AS DOUBLE) AS list_price, TRY_CAST(discount AS DOUBLE) AS discount")
_ITEMS_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ITEM_COLS)



def silver_sql(mark: str, extra: str) -> str:
    return f"""
WITH raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS VARCHAR) AS quantity,
         CAST(l_extendedprice AS VARCHAR) AS list_price, CAST(l_discount AS VARCHAR) AS discount,
         CAST(l_shipdate AS TIMESTAMP) AS _ingestion_timestamp
  FROM lineitem),
typed AS (SELECT {_ITEMS_TYPED}, _ingestion_timestamp FROM raw WHERE _ingestion_timestamp > {mark}),
latest AS ({latest_per_key("typed", ["order_id", "item_id", "product_id"],
                           ["_ingestion_timestamp", "quantity", "list_price", "discount"],
                           [*ITEM_COLS, "_ingestion_timestamp"])})
SELECT *, {extra}CAST(year(_ingestion_timestamp) AS INTEGER) AS year,
       CAST(month(_ingestion_timestamp) AS INTEGER) AS month
FROM latest
WHERE quantity > 0 AND list_price >= 0 AND discount BETWEEN 0 AND 1
  AND order_id IS NOT NULL AND item_id IS NOT NULL AND product_id IS NOT NULL"""


ORACLE.update({
    "dq_filter": with_ctes(f"SELECT * FROM m_order_items WHERE {_DQ_ITEMS}", "m_order_items"),
    "dq_filter_raw": with_ctes(f"""
SELECT {_ITEMS_TEXT} FROM m_order_items
WHERE TRY_CAST(CAST(quantity AS VARCHAR) AS INTEGER) > 0
  AND TRY_CAST(CAST(list_price AS VARCHAR) AS DOUBLE) >= 0
  AND TRY_CAST(CAST(discount AS VARCHAR) AS DOUBLE) BETWEEN 0 AND 0.05
  AND order_id IS NOT NULL AND item_id IS NOT NULL AND product_id IS NOT NULL""", "m_order_items"),
    "raw_row_hash": """
SELECT c_custkey, md5(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name,
       CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR), c_mktsegment)) AS _row_hash
FROM customer""",
    "silver_row_hash": with_ctes(
        f"SELECT {', '.join(ORDER_KEYS)}, {row_hash_sql(ORDER_COLS)} AS row_hash FROM m_orders",
        "m_orders"),
    "clean_text": f"SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents",
    "clean_text_all_runs":
        f"SELECT conv_id, turn, {clean_sql('text', 'all')} AS clean_text FROM conversations",
    "typed_projection": f"""
SELECT TRY_CAST(CAST(event_id AS VARCHAR) AS INTEGER) AS event_id,
       TRY_CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS user_id,
       {clean_sql('event_type')} AS event_type,
       TRY_CAST(CAST(value AS VARCHAR) AS INTEGER) AS value,
       {clean_sql('props')} AS props, ts
FROM events""",
    "typed_order_items": with_ctes(
        f"SELECT {_ITEMS_TYPED} FROM (SELECT {_ITEMS_TEXT} FROM m_order_items) r", "m_order_items"),
    "partition_columns": """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
FROM events""",
    "dedup_latest": latest_per_key("lineitem", ["l_orderkey", "l_linenumber"],
                                   ["l_shipdate", *_LI_REST], _LI_COLS),
    "watermark_max": """
SELECT event_type AS table_name, max(ts) AS last_watermark FROM events GROUP BY event_type""",
    "incremental_slice": f"""
WITH marks AS (SELECT event_type AS table_name, max(ts) AS last_watermark
               FROM events WHERE ts <= {EVENTS_CUT} GROUP BY event_type)
SELECT e.* FROM events e LEFT JOIN marks m ON e.event_type = m.table_name
WHERE m.last_watermark IS NULL OR e.ts > m.last_watermark""",
    "incremental_slice_literal": f"SELECT * FROM events WHERE ts > {EVENTS_CUT}",
    "merge_conditional": with_ctes(
        "SELECT * FROM (" + merge_sql(
            f"(SELECT *, {row_hash_sql(ORDER_COLS)} AS row_hash FROM m_orders_c)",
            f"(SELECT *, {row_hash_sql(ORDER_COLS)} AS row_hash FROM m_orders "
            f"WHERE order_date >= {ORDERS_CUT} - INTERVAL 90 DAY)",
            ORDER_KEYS, [*ORDER_COLS, "row_hash"], "row_hash", True) + ") m",
        "m_orders", "m_orders_c"),
    **{name: with_ctes(
        "SELECT * FROM (" + merge_sql(
            f"(SELECT *, {row_hash_sql(ORDER_COLS)} AS row_hash FROM m_orders_c)",
            f"(SELECT *, {row_hash_sql(ORDER_COLS)} AS row_hash FROM m_orders "
            f"WHERE order_date >= {ORDERS_CUT} - INTERVAL 90 DAY)",
            keys, [*ORDER_COLS, "row_hash"], "row_hash", null_safe) + ") m",
        "m_orders", "m_orders_c")
       for name, keys, null_safe in (
           ("merge_touched_partitions", ORDER_KEYS, True),
           ("merge_null_keys_orders", [*ORDER_KEYS, "shipped_date"], False),
           ("merge_null_safe_orders", [*ORDER_KEYS, "shipped_date"], True))},
    "merge_unconditional": "SELECT * FROM (" + merge_sql(
        "(" + latest_per_key(f"(SELECT {', '.join(_EV)} FROM events WHERE ts <= {EVENTS_CUT})",
                             ["user_id"], ["ts", "event_id", "event_type", "value"], _EV) + ")",
        "(" + latest_per_key(f"(SELECT {', '.join(_EV)} FROM events WHERE ts > {EVENTS_CUT})",
                             ["user_id"], ["ts", "event_id", "event_type", "value"], _EV) + ")",
        ["user_id"], _EV, None, True) + ") m",
    "orders_derived": with_ctes(
        f"SELECT o.*, {ORDERS_DERIVED} FROM m_orders o", "m_orders"),
    "items_derived": with_ctes("""
SELECT *, quantity * list_price AS gross_amount,
       quantity * list_price * (1 - discount) AS net_amount
FROM m_order_items""", "m_order_items"),
    "silver_transform": silver_sql("TIMESTAMP '1900-01-01'", ""),
    "silver_incremental": silver_sql("TIMESTAMP '1998-06-01'", row_hash_sql(ITEM_COLS) + " AS row_hash, "),
    "clean_null_tokens": f"""
SELECT doc_id, {clean_sql('t')} AS clean_text
FROM (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN '' WHEN 1 THEN ' N/A ' WHEN 2 THEN 'na' WHEN 3 THEN 'NULL'
             WHEN 4 THEN '-' ELSE text END AS t FROM documents)""",
    "clean_null_spellings": f"""
SELECT doc_id, {clean_sql('text')} AS clean_text, count(*) FILTER (WHERE line IS NULL) AS null_lines
FROM (SELECT doc_id, text, n, {clean_sql('l')} AS line
      FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS l, row_number() OVER () AS n FROM documents))
GROUP BY doc_id, text""",
    "rank_with_ties": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, RANK() OVER (ORDER BY l_quantity DESC) AS quantity_rank
FROM lineitem""",
    "gold_changed_orders": with_ctes("""
SELECT * FROM m_orders
WHERE coalesce(shipped_date, order_date) > DATE '2001-01-01' OR shipped_date IS NULL
   OR order_date >= DATE '2001-06-01' - INTERVAL 7 DAY
   OR order_id IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-01-01')
   OR customer_id IN (SELECT c_custkey FROM customer WHERE DATE '1997-01-01' + CAST(c_custkey AS INTEGER) > DATE '2001-01-01')""",
                                     "m_orders"),
    "dim_date_lookback": with_ctes(
        "SELECT * FROM g_dim_date WHERE full_date > " + LAST_PROCESSED + " - INTERVAL 7 DAY",
        "g_dim_date"),
    "fact_lookback": with_ctes(
        first_per_key("(" + fact_sql(LAST_PROCESSED) + ")",
                      ["order_id", "product_id", "customer_key", "store_key"], FACT_REST, FACT_COLS),
        *_GOLD_DEPS),
})


def _staff_merge_sql(null_safe: bool) -> str:
    cleaned = ", ".join(clean_sql(c) + f" AS {c}" if c in ("first_name", "last_name", "phone", "email")
                        else c for c in STAFF_COLS)
    target = f"(SELECT *, {row_hash_sql(STAFF_COLS)} AS row_hash FROM m_staffs)"
    source = (f"(SELECT *, {row_hash_sql(STAFF_COLS)} AS row_hash FROM "
              f"(SELECT {cleaned} FROM m_staffs) c)")
    return with_ctes("SELECT * FROM (" + merge_sql(
        target, source, ["staff_id", "store_id", "manager_id"], [*STAFF_COLS, "row_hash"],
        "row_hash", null_safe) + ") m", "m_staffs")


ORACLE["merge_null_keys"] = _staff_merge_sql(False)
ORACLE["merge_null_safe"] = _staff_merge_sql(True)

# A refresh from the changed months gives what a refresh of the whole fact gives.
ORACLE["agg_monthly_billing_refreshed"] = ORACLE["agg_monthly_billing"]
