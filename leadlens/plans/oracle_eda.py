"""DuckDB oracle text for the cleaning and statistics queries."""

from __future__ import annotations

from ..schema import FACT_COLUMNS
from .oracle_fact import with_fact

BASE = [n for n, _ in FACT_COLUMNS]
NUMERIC = [n for n, t in FACT_COLUMNS if t != "string"]
STRING = [n for n, t in FACT_COLUMNS if t == "string"]

GAPS_CTE = """gaps AS (SELECT product_type, sku, CASE WHEN availability <= 45 THEN price END AS price,
  availability, number_of_products_sold, revenue_generated,
  CASE WHEN stock_levels <> 0 THEN customer_demographics END AS customer_demographics,
  stock_levels, lead_times, order_quantities, shipping_times, shipping_carriers, shipping_costs,
  supplier_name, location, lead_time,
  CASE WHEN production_volumes <= 400 THEN production_volumes END AS production_volumes,
  manufacturing_lead_time, manufacturing_costs,
  ' ' || lower(inspection_results) || chr(9) AS inspection_results,
  CASE WHEN manufacturing_lead_time <> 0 THEN defect_rates END AS defect_rates,
  lower(transportation_modes) || '  ' AS transportation_modes,
  CASE WHEN lead_time <= 18 THEN routes END AS routes, costs FROM fact)"""

GAP_COLS = ["product_type", "sku", "price", "availability", "number_of_products_sold", "revenue_generated",
            "customer_demographics", "stock_levels", "lead_times", "order_quantities", "shipping_times",
            "shipping_carriers", "shipping_costs", "supplier_name", "location", "lead_time", "production_volumes",
            "manufacturing_lead_time", "manufacturing_costs", "inspection_results", "defect_rates",
            "transportation_modes", "routes", "costs"]


def title_sql(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), "
            f"lambda s: upper(s[1]) || lower(s[2:])), '')")


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _mode(col: str, src: str = "gaps") -> str:
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


def _imputed_cte() -> str:
    # production_volumes is the one column over half empty; price and
    # defect_rates get medians, customer_demographics and routes modes.
    cols = []
    for c in GAP_COLS:
        if c == "production_volumes":
            continue
        if c in ("price", "defect_rates"):
            cols.append(f"coalesce(cast({c} AS double), (SELECT median(cast({c} AS double)) FROM gaps)) AS {c}")
        elif c in ("customer_demographics", "routes"):
            cols.append(f"coalesce({c}, {_mode(c)}) AS {c}")
        else:
            cols.append(c)
    return "imputed AS (SELECT " + ", ".join(cols) + " FROM gaps)"


def _corr(a: str, b: str) -> str:
    x, y = f"cast({a} AS double)", f"cast({b} AS double)"
    xs = f"CASE WHEN {y} IS NULL THEN NULL ELSE {x} END"
    ys = f"CASE WHEN {x} IS NULL THEN NULL ELSE {y} END"
    return f"round(covar_pop({x}, {y}) / nullif(stddev_pop({xs}) * stddev_pop({ys}), 0), 6)"


def _matrix_sql() -> str:
    parts = []
    for i, a in enumerate(NUMERIC):
        for j, b in enumerate(NUMERIC):
            lo, hi = (i, j) if j <= i else (j, i)
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {i} AS i, {j} AS j, "
                         f"{_corr(NUMERIC[lo], NUMERIC[hi])} AS corr FROM fact")
    return "m AS (" + "\nUNION ALL ".join(parts) + ")"


def eda_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["missing_profile"] = with_fact(
        "SELECT \"column\", missing_count, round(cast(missing_count AS double) * 100.0 / n, 6) AS missing_pct FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, count(*) AS n FROM gaps"
                             for c in GAP_COLS)
        + ") ORDER BY missing_pct DESC, \"column\"", GAPS_CTE)
    q["duplicate_count"] = with_fact(
        f"SELECT cast(coalesce(sum(n - 1), 0) AS bigint) AS duplicate_rows FROM "
        f"(SELECT count(*) AS n FROM fact GROUP BY {', '.join(BASE)})")
    q["category_audit"] = with_fact(" UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM fact WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY count DESC, value LIMIT 5)" for c in STRING))
    q["drop_sparse_columns"] = with_fact("SELECT * EXCLUDE (production_volumes) FROM gaps", GAPS_CTE)
    q["impute_median_mode"] = with_fact("SELECT * FROM imputed", GAPS_CTE, _imputed_cte())
    base = ", ".join(BASE)
    q["dedupe"] = with_fact(f"SELECT DISTINCT {base} FROM (SELECT {base} FROM fact UNION ALL "
                            f"SELECT {base} FROM fact WHERE lead_time > 20)")
    q["distinct_categories"] = with_fact("SELECT DISTINCT product_type, customer_demographics, shipping_carriers, location, "
                                         "transportation_modes, routes FROM fact")
    q["standardise_text"] = with_fact(
        f"SELECT sku, {title_sql(strip_sql('inspection_results'))} AS inspection_results, "
        f"{title_sql(strip_sql('transportation_modes'))} AS transportation_modes FROM gaps", GAPS_CTE)
    cleaned_cols = []
    for c in GAP_COLS:
        if c == "production_volumes":
            continue
        if c in ("inspection_results", "transportation_modes"):
            cleaned_cols.append(f"{title_sql(strip_sql(c))} AS {c}")
        else:
            cleaned_cols.append(c)
    q["cleaned_table"] = with_fact(
        "SELECT " + ", ".join(cleaned_cols) + " FROM (SELECT DISTINCT * FROM imputed)", GAPS_CTE, _imputed_cte())

    desc = []
    for c in NUMERIC:
        x = f"cast({c} AS double)"
        desc.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, "
            f"round(cast(sum(cast({c} AS decimal(38,10))) AS double) / count({c}), 6) AS mean, "
            f"round(round(stddev_samp({x}), 8), 6) AS std, min({x}) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50, "
            f"round(quantile_cont({x}, 0.75), 6) AS q75, max({x}) AS max FROM fact")
    q["describe_numeric"] = with_fact(" UNION ALL ".join(desc))
    q["mean_median"] = with_fact("SELECT cast(sum(lead_time) AS double) / count(lead_time) AS mean, "
                                 "median(cast(lead_time AS double)) AS median FROM fact")
    q["histogram20"] = with_fact(
        """SELECT g.bin, round(r.lo + (g.bin - 1) * ((r.hi - r.lo) / 20), 6) AS bin_start,
  round(r.lo + g.bin * ((r.hi - r.lo) / 20), 6) AS bin_end, cast(coalesce(c.count, 0) AS bigint) AS count
FROM r CROSS JOIN (SELECT unnest(range(1, 21)) AS bin) g
LEFT JOIN (SELECT CASE WHEN r.hi = r.lo THEN 1 ELSE least(20, cast(floor((cast(lead_time AS double) - r.lo)
    / ((r.hi - r.lo) / 20)) AS int) + 1) END AS bin, count(*) AS count
  FROM fact CROSS JOIN r WHERE lead_time IS NOT NULL GROUP BY 1) c ON c.bin = g.bin ORDER BY g.bin""",
        "r AS (SELECT cast(min(lead_time) AS double) AS lo, cast(max(lead_time) AS double) AS hi FROM fact)")
    q["box_summary"] = with_fact(
        """SELECT q1, median, q3,
  min(CASE WHEN x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_low,
  max(CASE WHEN x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_high,
  cast(count(CASE WHEN x IS NOT NULL AND NOT (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
    THEN 1 END) AS bigint) AS fliers
FROM (SELECT cast(lead_time AS double) AS x FROM fact) CROSS JOIN q GROUP BY q1, median, q3""",
        "q AS (SELECT quantile_cont(cast(lead_time AS double), 0.25) AS q1, "
        "quantile_cont(cast(lead_time AS double), 0.5) AS median, "
        "quantile_cont(cast(lead_time AS double), 0.75) AS q3 FROM fact)")
    q["correlation_matrix"] = with_fact("SELECT x, y, i, j, corr FROM m", _matrix_sql())
    q["target_correlations_top"] = with_fact(
        "SELECT x AS feature, corr FROM m WHERE y = 'lead_time' ORDER BY corr DESC NULLS LAST, feature LIMIT 10",
        _matrix_sql())
    q["target_correlations_bottom"] = with_fact(
        "SELECT * FROM (SELECT x AS feature, corr FROM m WHERE y = 'lead_time' "
        "ORDER BY corr ASC NULLS FIRST, feature DESC LIMIT 10) ORDER BY corr DESC, feature", _matrix_sql())
    q["correlation_lower_triangle"] = with_fact("SELECT x, y, i, j, corr FROM m WHERE i > j ORDER BY i, j",
                                                _matrix_sql())
    q["frequency_in_key_order"] = with_fact(
        "SELECT supplier_name, count(*) AS count FROM fact WHERE supplier_name IS NOT NULL GROUP BY supplier_name ORDER BY supplier_name")
    q["value_counts_top10"] = with_fact(" UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM fact WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY count DESC, value LIMIT 10)" for c in STRING[:3]))
    q["category_mean_top10"] = with_fact(" UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, "
        f"cast(sum(lead_time) AS double) / count(lead_time) AS avg_lead_time FROM fact "
        f"GROUP BY {c} ORDER BY avg_lead_time DESC, value LIMIT 10)" for c in STRING[:3]))
    return q
