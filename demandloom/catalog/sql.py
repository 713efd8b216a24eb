"""Shared parts of the comparison SQL: the retail views as CTEs and small generators."""

from __future__ import annotations

VIEWS = """
transactions AS (
  SELECT CAST(o_custkey AS VARCHAR) internal_store_id, CAST(l_partkey AS VARCHAR) internal_product_id,
         l_suppkey distributor_id, CAST(l_shipdate AS DATE) transaction_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) reference_date,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END quantity,
         l_extendedprice gross_value, l_extendedprice * l_discount discount,
         l_extendedprice * (1 - l_discount) * l_tax taxes, l_extendedprice * (1 - l_discount) net_value,
         l_extendedprice * (1 - l_discount) * (1 - l_tax) gross_profit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
stores AS (
  SELECT CAST(c_custkey AS VARCHAR) pdv,
         CASE WHEN c_custkey % 3 = 0 THEN 'On Premise' ELSE 'Off Premise' END premise,
         c_mktsegment categoria_pdv, 8100 + c_nationkey zipcode
  FROM customer),
sku AS (
  SELECT CAST(p_partkey AS VARCHAR) produto, p_name descricao, p_type categoria, p_brand subcategoria FROM part),
positive AS (SELECT *, CAST(week(transaction_date) AS INTEGER) AS wk FROM transactions WHERE quantity > 0),
active AS (SELECT * FROM stores WHERE pdv IN (SELECT internal_store_id FROM positive)),
sales AS (SELECT * FROM positive WHERE internal_store_id IN (SELECT pdv FROM active))
"""

FACTS = """
facts AS (
  SELECT internal_store_id, wk AS week, COUNT(*) product_rows, COUNT(DISTINCT internal_product_id) product_diversity,
         SUM(quantity) quantity, SUM(gross_value) gross_value, SUM(net_value) net_value,
         SUM(gross_profit) gross_profit, SUM(discount) discount, SUM(taxes) taxes
  FROM sales GROUP BY 1, 2),
calendar AS (
  SELECT s.internal_store_id, CAST(w.week AS INTEGER) AS week,
         COALESCE(f.quantity, 0) quantity, COALESCE(f.gross_value, 0) gross_value, COALESCE(f.net_value, 0) net_value,
         COALESCE(f.gross_profit, 0) gross_profit, COALESCE(f.discount, 0) discount, COALESCE(f.taxes, 0) taxes,
         CAST(COALESCE(f.product_diversity, 0) AS DOUBLE) product_diversity, f.week IS NOT NULL AS sold
  FROM (SELECT DISTINCT internal_store_id FROM facts) s
  CROSS JOIN (SELECT UNNEST(range(1, 53)) AS week) w
  LEFT JOIN facts f ON f.internal_store_id = s.internal_store_id AND f.week = w.week)
"""

# Arms and draws; {source} is positive sales with a product column.
BANDIT = """
arm_weeks AS (
  SELECT categoria_pdv, {product} AS internal_product_id,
         COUNT(DISTINCT CASE WHEN wk <= 52 THEN wk END) AS n, MAX(CASE WHEN wk <= 52 THEN wk END) AS last_week
  FROM {source} JOIN stores ON pdv = internal_store_id GROUP BY 1, 2),
params AS (
  SELECT categoria_pdv, internal_product_id, CASE WHEN n > 0 THEN 1 + n END AS a,
         CASE WHEN n > 0 THEN 1 + last_week - n END AS b
  FROM arm_weeks),
uniforms AS (
  SELECT categoria_pdv, internal_product_id, a, b, i,
         (CAST(('0x' || substr(md5('42:' || length(categoria_pdv) || ':' || categoria_pdv || '|' || internal_product_id || ':' || i), 1, 13)) AS BIGINT)
           + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM (SELECT *, UNNEST(range(0, least(a, b))) AS i FROM params WHERE a IS NOT NULL)),
drawn AS (
  SELECT p.categoria_pdv, p.internal_product_id,
         CASE WHEN d.x IS NULL THEN 0.0::DOUBLE WHEN p.b < p.a THEN d.x ELSE 1 - d.x END AS probability
  FROM params p LEFT JOIN (
    SELECT categoria_pdv, internal_product_id, exp(SUM(ln(u) / (a + b - 1 - i))) AS x FROM uniforms GROUP BY 1, 2
  ) d USING (categoria_pdv, internal_product_id)),
shares AS (
  SELECT categoria_pdv, internal_product_id, probability,
         CASE WHEN SUM(probability) OVER (PARTITION BY categoria_pdv) > 0
              THEN probability / SUM(probability) OVER (PARTITION BY categoria_pdv) END AS share
  FROM drawn)
"""

PRODUCT_BANDIT = BANDIT.format(source="positive", product="internal_product_id")
BRAND_BANDIT = (
    "brand_sales AS (SELECT p.*, subcategoria AS brand FROM positive p JOIN sku ON produto = internal_product_id),"
    + BANDIT.format(source="brand_sales", product="brand")
)

PROFILE = """
profile AS (
  SELECT pdv, CASE WHEN CAST(zipcode AS VARCHAR) = '8107' THEN '08107' ELSE CAST(zipcode AS VARCHAR) END zipcode,
         COUNT(*) transaction_rows, AVG(quantity) quantity, AVG(net_value) net_value,
         COUNT(DISTINCT distributor_id) distributor_count, COUNT(*) transaction_count
  FROM active JOIN sales ON pdv = internal_store_id GROUP BY 1, 2),
codes AS (SELECT zipcode, CAST(row_number() OVER (ORDER BY zipcode) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT zipcode FROM profile)),
coded AS (
  SELECT pdv, CAST(code AS DOUBLE) zipcode, CAST(transaction_rows AS DOUBLE) transaction_rows, quantity, net_value,
         CAST(distributor_count AS DOUBLE) distributor_count, CAST(transaction_count AS DOUBLE) transaction_count
  FROM profile JOIN codes USING (zipcode)),
scaled AS (
  SELECT pdv,
    (zipcode - AVG(zipcode) OVER ()) / STDDEV_POP(zipcode) OVER () AS zipcode,
    (transaction_rows - AVG(transaction_rows) OVER ()) / STDDEV_POP(transaction_rows) OVER () AS transaction_rows,
    (quantity - AVG(quantity) OVER ()) / STDDEV_POP(quantity) OVER () AS quantity,
    (net_value - AVG(net_value) OVER ()) / STDDEV_POP(net_value) OVER () AS net_value,
    (distributor_count - AVG(distributor_count) OVER ()) / STDDEV_POP(distributor_count) OVER () AS distributor_count,
    (transaction_count - AVG(transaction_count) OVER ()) / STDDEV_POP(transaction_count) OVER () AS transaction_count
  FROM coded)
"""

DISTANCE = "sqrt(" + " + ".join(
    f"(a.{c} - b.{c}) * (a.{c} - b.{c})"
    for c in ("zipcode", "transaction_rows", "quantity", "net_value", "distributor_count", "transaction_count")
) + ")"


def with_views(body: str, *more: str) -> str:
    """Prefix a SELECT with the views and further CTE groups."""
    return "WITH RECURSIVE " + ",".join([VIEWS, *more]) + body


def grid(name: str, alias: str | None = None) -> str:
    """Sums of the sample measures have at most six decimals."""
    return f"round({name}, 6) AS {alias or name}"


def stable(expression: str, alias: str) -> str:
    """Means as nearest float: engines differ only in the last bits of a double."""
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE) AS {alias}"


def lagged(measures, length: int = 13) -> str:
    """Numbered window columns as lags over the dense calendar."""
    return ", ".join(
        f"round(LAG({m}, {length - k}) OVER w, 6) AS {m}{k:02d}" for m in measures for k in range(1, length + 1)
    )


def windowed(measures) -> str:
    """CTE ``windows``: all full windows, labelled by their last week."""
    return (
        f"windows AS (SELECT * FROM (SELECT internal_store_id, week, {lagged(measures)} FROM calendar "
        "WINDOW w AS (PARTITION BY internal_store_id ORDER BY week)) WHERE week >= 13)"
    )
