"""DuckDB CTEs for the retail model over the TPC-H-style views, written from
the mapping's definition (not from the Spark code): a correlated subquery
for the ship date, window numbering for categories, joins for customers."""

M_ORDERS = """
m_orders AS (
  SELECT CAST(o.o_orderkey AS INTEGER) AS order_id,
         CAST(o.o_custkey AS INTEGER) AS customer_id,
         CASE o.o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 4 END AS order_status,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(o.o_orderdate AS DATE)
           + CAST(30 * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS INTEGER) AS required_date,
         (SELECT max(CAST(l.l_shipdate AS DATE)) FROM lineitem l
           WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate >= o.o_orderdate) AS shipped_date,
         CAST(o.o_orderkey % 10 AS INTEGER) AS store_id,
         CAST(o.o_orderkey % 25 AS INTEGER) AS staff_id
  FROM orders o
)"""

M_ORDER_ITEMS = """
m_order_items AS (
  SELECT CAST(l_orderkey AS INTEGER) AS order_id,
         CAST(l_linenumber AS INTEGER) AS item_id,
         CAST(l_partkey AS INTEGER) AS product_id,
         CAST(round(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice / NULLIF(l_quantity, 0) AS list_price,
         l_discount AS discount
  FROM lineitem
)"""

M_CATEGORIES = """
m_categories AS (
  SELECT CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS category_id,
         p_type AS category_name
  FROM (SELECT DISTINCT p_type FROM part) t
)"""

M_BRANDS = """
m_brands AS (
  SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_id, p_brand AS brand_name
  FROM part
)"""

M_PRODUCTS = """
m_products AS (
  SELECT CAST(p.p_partkey AS INTEGER) AS product_id,
         CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS brand_id,
         c.category_id,
         p.p_name AS product_name,
         CAST(2000 + p.p_size AS INTEGER) AS model_year,
         p.p_retailprice AS list_price
  FROM part p JOIN m_categories c ON c.category_name = p.p_type
)"""

M_CUSTOMERS = """
m_customers AS (
  SELECT CAST(c.c_custkey AS INTEGER) AS customer_id,
         'Customer' AS first_name,
         split_part(c.c_name, '#', 2) AS last_name,
         CAST(NULL AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS email,
         CAST(NULL AS VARCHAR) AS street,
         n.n_name AS city,
         r.r_name AS state,
         CAST(NULL AS VARCHAR) AS zip_code
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

M_STORES = """
m_stores AS (
  SELECT CAST(s_suppkey AS INTEGER) AS store_id, s_name AS store_name,
         CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email,
         CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip_code
  FROM supplier
)"""

M_STAFFS = """
m_staffs AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS staff_id,
         CAST(n.n_regionkey AS INTEGER) AS store_id,
         CASE WHEN n.n_nationkey = 0 THEN NULL ELSE 0 END AS manager_id,
         n.n_name AS first_name, r.r_name AS last_name,
         CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email,
         1 AS active
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

ALL = {
    "m_orders": M_ORDERS, "m_order_items": M_ORDER_ITEMS, "m_categories": M_CATEGORIES,
    "m_brands": M_BRANDS, "m_products": M_PRODUCTS, "m_customers": M_CUSTOMERS,
    "m_stores": M_STORES, "m_staffs": M_STAFFS,
}


def orders_as_of(name: str, cutoff: str) -> str:
    """m_orders as it stood at the end of ``cutoff`` (a DATE literal)."""
    end = f"CAST({cutoff} + INTERVAL 1 DAY AS TIMESTAMP)"
    return (M_ORDERS.replace("m_orders AS", f"{name} AS", 1)
            .replace("AND l.l_shipdate >= o.o_orderdate)",
                     f"AND l.l_shipdate >= o.o_orderdate AND l.l_shipdate < {end})")
            .replace("FROM orders o\n", f"FROM orders o WHERE o.o_orderdate < {end}\n"))
