"""DuckDB text of the fact relation, used as a CTE by every oracle query.

It mirrors ``sources.fact.build_fact`` column for column; only the
lead-time expression is spelled in DuckDB's dialect.
"""

FACT_CTE = """fact AS (
  SELECT p_type AS product_type,
    concat('SKU', cast(p_partkey AS varchar)) AS sku,
    cast(p_retailprice AS decimal(10,2)) AS price,
    p_size AS availability,
    cast(l_quantity AS int) + l_linenumber AS number_of_products_sold,
    cast(l_extendedprice AS decimal(12,2)) AS revenue_generated,
    c_mktsegment AS customer_demographics,
    l_linenumber - 1 AS stock_levels,
    l_linenumber * 4 AS lead_times,
    cast(l_quantity AS int) AS order_quantities,
    l_linenumber AS shipping_times,
    l_linestatus AS shipping_carriers,
    cast(round(l_tax * 100) AS decimal(10,2)) AS shipping_costs,
    s_name AS supplier_name,
    r_name AS location,
    cast(((date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) % 30) + 30) % 30 + 1 AS int) AS lead_time,
    p_size * 20 AS production_volumes,
    cast(l_orderkey % 31 AS int) AS manufacturing_lead_time,
    cast(abs(s_acctbal) AS decimal(12,2)) AS manufacturing_costs,
    CASE l_returnflag WHEN 'A' THEN 'Pass' WHEN 'R' THEN 'Fail' ELSE 'Pending' END AS inspection_results,
    cast(round(l_discount * 100) * 0.5 AS decimal(5,2)) AS defect_rates,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Air' WHEN '2-HIGH' THEN 'Road' WHEN '3-MEDIUM' THEN 'Sea'
         WHEN '4-NOT SPECIFIED' THEN 'Rail' ELSE 'Other' END AS transportation_modes,
    o_orderstatus AS routes,
    cast(o_totalprice AS decimal(12,2)) AS costs,
    o_orderdate AS order_date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def with_fact(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the fact CTE and any extra ``name AS (...)`` CTEs."""
    return "WITH " + ",\n".join((FACT_CTE,) + ctes) + "\n" + body
