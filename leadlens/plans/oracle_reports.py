"""DuckDB oracle text for the reports (same aliases as the Spark side)."""

from __future__ import annotations

from .oracle_fact import with_fact


def M(x: str) -> str:  # exact mean, as functions.aggs.mean
    return f"cast(sum({x}) AS double) / count({x})"


def SP(x: str) -> str:  # population std, as functions.aggs.std_pop
    return f"round(stddev_pop(cast({x} AS double)), 8)"


def corr_moments(x: str, y: str) -> str:
    n = "cast(count(*) AS decimal(20,0))"
    num = f"cast({n} * sum({x} * {y}) - sum({x}) * sum({y}) AS double)"
    vx = f"cast({n} * sum({x} * {x}) - sum({x}) * sum({x}) AS double)"
    vy = f"cast({n} * sum({y} * {y}) - sum({y}) * sum({y}) AS double)"
    return f"round({num} / nullif(sqrt({vx} * {vy}), 0), 10)"


def report_sql(params: dict) -> dict[str, str]:
    p = params
    items = f"""SELECT * FROM (SELECT 'Top 5 Longest Lead Time SKUs' AS insight_type, sku AS details,
      cast(lead_time AS double) AS metric, 1 AS s FROM fact ORDER BY lead_time DESC, sku LIMIT 5)
  UNION ALL
  SELECT 'Locations Needing Improvement', location, {M('lead_time')}, 2 FROM fact GROUP BY location
    HAVING {M('lead_time')} > {p['location_avg']}
  UNION ALL
  SELECT 'High Defect Suppliers', supplier_name, {M('defect_rates')}, 3 FROM fact GROUP BY supplier_name
    HAVING {M('defect_rates')} > {p['supplier_defect']}"""
    lt = "cast(lead_time AS decimal(18,0))"
    return {
        "overview": with_fact("""SELECT count(*) AS total_rows, count(DISTINCT sku) AS unique_skus,
  count(DISTINCT product_type) AS unique_product_types, count(DISTINCT location) AS unique_locations,
  count(DISTINCT supplier_name) AS unique_suppliers FROM fact"""),
        "product_type_brief": with_fact(f"""SELECT product_type, count(*) AS count, {M('lead_time')} AS avg_lead_time,
  {SP('lead_time')} AS std_lead_time FROM fact GROUP BY product_type ORDER BY avg_lead_time DESC"""),
        "null_counts": with_fact("""SELECT
  cast(sum(CASE WHEN lead_time IS NULL THEN 1 ELSE 0 END) AS bigint) AS missing_lead_time,
  cast(sum(CASE WHEN defect_rates IS NULL THEN 1 ELSE 0 END) AS bigint) AS missing_defect_rates,
  cast(sum(CASE WHEN production_volumes IS NULL THEN 1 ELSE 0 END) AS bigint) AS missing_prod_vol FROM fact"""),
        "target_range": with_fact(f"""SELECT min(lead_time) AS min_lead_time, max(lead_time) AS max_lead_time,
  {M('lead_time')} AS avg_lead_time, {SP('lead_time')} AS std_lead_time FROM fact"""),
        "lead_time_bins": with_fact("""SELECT cast(floor(lead_time / 5.0) * 5 AS bigint) AS lead_time_bin,
  count(*) AS frequency FROM fact GROUP BY 1 ORDER BY 1"""),
        "correlation_moments": with_fact(f"""SELECT
  {corr_moments(lt, 'defect_rates')} AS corr_defect_rates,
  {corr_moments(lt, 'cast(production_volumes AS decimal(18,0))')} AS corr_production_volumes,
  {corr_moments(lt, 'price')} AS corr_price FROM fact"""),
        "product_type_stats": with_fact(f"""SELECT product_type, count(*) AS record_count,
  {M('lead_time')} AS avg_lead_time, min(lead_time) AS min_lead_time, max(lead_time) AS max_lead_time,
  {SP('lead_time')} AS std_lead_time FROM fact GROUP BY product_type ORDER BY avg_lead_time DESC"""),
        "by_location": with_fact(f"""SELECT location, count(*) AS record_count, {M('lead_time')} AS avg_lead_time
  FROM fact GROUP BY location ORDER BY avg_lead_time DESC"""),
        "by_mode": with_fact(f"""SELECT transportation_modes, count(*) AS record_count,
  {M('lead_time')} AS avg_lead_time FROM fact GROUP BY transportation_modes ORDER BY avg_lead_time"""),
        "by_supplier": with_fact(f"""SELECT supplier_name, count(*) AS total_orders, {M('lead_time')} AS avg_lead_time,
  {M('defect_rates')} AS avg_defect_rate, {M('production_volumes')} AS avg_production_volume
  FROM fact GROUP BY supplier_name HAVING count(*) > {p['min_orders']} ORDER BY avg_lead_time DESC"""),
        "by_mode_route": with_fact(f"""SELECT transportation_modes, routes, count(*) AS shipments,
  {M('lead_time')} AS avg_lead_time, {M('shipping_costs')} AS avg_shipping_cost
  FROM fact GROUP BY transportation_modes, routes ORDER BY avg_lead_time"""),
        "by_demographics": with_fact(f"""SELECT customer_demographics, count(*) AS order_count,
  {M('lead_time')} AS avg_lead_time, {M('order_quantities')} AS avg_order_quantity
  FROM fact GROUP BY customer_demographics ORDER BY avg_lead_time DESC"""),
        "volume_band": with_fact(f"""SELECT CASE WHEN production_volumes < 300 THEN 'Low Volume'
    WHEN production_volumes BETWEEN 300 AND 700 THEN 'Medium Volume'
    WHEN production_volumes > 700 THEN 'High Volume' END AS volume_category,
  count(*) AS record_count, {M('lead_time')} AS avg_lead_time, {M('defect_rates')} AS avg_defect_rate
  FROM fact GROUP BY 1 ORDER BY avg_lead_time DESC"""),
        "product_by_location": with_fact(f"""SELECT product_type, location, count(*) AS record_count,
  {M('lead_time')} AS avg_lead_time, {M('defect_rates')} AS avg_defect_rate
  FROM fact GROUP BY product_type, location ORDER BY product_type, avg_lead_time DESC"""),
        "monthly_snapshot": with_fact(f"""SELECT strftime(order_date, '%Y-%m') AS month, product_type,
  count(*) AS total_orders, {M('lead_time')} AS avg_lead_time, {M('defect_rates')} AS avg_defect_rate
  FROM fact GROUP BY 1, 2 ORDER BY month DESC, avg_lead_time DESC"""),
        "high_lead_time": with_fact(f"""SELECT sku, product_type, lead_time, cast(defect_rates AS double) AS defect_rates,
  production_volumes, cast(price AS double) AS price FROM fact WHERE lead_time > {p['lead_threshold']}
  ORDER BY lead_time DESC"""),
        "high_defect": with_fact("""SELECT sku, product_type, cast(defect_rates AS double) AS defect_rates, lead_time,
  inspection_results FROM fact WHERE defect_rates > 2.0 ORDER BY defect_rates DESC"""),
        "bottleneck_class": with_fact(f"""SELECT sku, product_type, location, lead_time,
  cast(defect_rates AS double) AS defect_rates, production_volumes,
  CASE WHEN defect_rates > 2.0 AND production_volumes > 700 THEN 'High Defect & High Volume'
       WHEN defect_rates > 2.0 THEN 'High Defect'
       WHEN production_volumes > 700 THEN 'High Volume'
       WHEN price > {p['premium_price']} AND lead_time > 20 THEN 'Premium & Delayed'
       ELSE 'Normal' END AS bottleneck_category
  FROM fact ORDER BY lead_time DESC"""),
        "recommendation_summary": with_fact(f"""SELECT insight_type, details, metric FROM ({items}) ORDER BY s, metric DESC, details"""),
        "recommendation_text": with_fact(f"""SELECT insight_type, count(*) AS total, count(*) FILTER (r <= {p['listed']}) AS listed,
  string_agg(details, ',' ORDER BY r) FILTER (r <= {p['listed']}) AS details FROM (
    SELECT *, row_number() OVER (PARTITION BY s ORDER BY metric DESC, details) AS r FROM ({items})) GROUP BY insight_type"""),
    }
