"""DuckDB oracle text for the feature, split and nearest-neighbour queries."""

from __future__ import annotations

from ..schema import DEFECT_BIN_EDGES, DEFECT_BIN_LABELS, FACT_COLUMNS, VOLUME_QUARTILE_LABELS
from .oracle_fact import with_fact

NUMERIC = [n for n, t in FACT_COLUMNS if t != "string"]
STRING = [n for n, t in FACT_COLUMNS if t == "string"]
ENC_COLS = [c for c in STRING if c != "sku"]
KNN_FEATURES = [c for c in NUMERIC if c != "lead_time"]


def M(x: str) -> str:
    return f"cast(sum({x}) AS double) / count({x})"


def D(x: str) -> str:
    return f"cast({x} AS double)"


def z1(x: str) -> str:  # pandas .replace(0, 1) on a divisor
    return f"CASE WHEN {D(x)} = 0 THEN 1.0 ELSE {D(x)} END"


def items_ctes() -> list[str]:
    """SKU grain: numeric means, product type, modal category values."""
    num = ", ".join(f"{M(c)} AS {c}" for c in NUMERIC)
    ctes = [f"inum AS (SELECT sku, min(product_type) AS product_type, {num} FROM fact GROUP BY sku)"]
    cats = [c for c in STRING if c not in ("sku", "product_type")]
    for c in cats:
        ctes.append(f"m_{c} AS (SELECT sku, first({c} ORDER BY n DESC, {c}) AS {c} FROM "
                    f"(SELECT sku, {c}, count(*) AS n FROM fact WHERE {c} IS NOT NULL GROUP BY sku, {c}) GROUP BY sku)")
    joins = " ".join(f"LEFT JOIN m_{c} USING (sku)" for c in cats)
    cols = ", ".join(n for n, _ in FACT_COLUMNS)
    ctes.append(f"items AS (SELECT {cols} FROM inum {joins})")
    return ctes


def split_ctes(seed: int = 42, test_size: float = 0.2) -> list[str]:
    return items_ctes() + [
        f"h AS (SELECT *, md5('{seed}|' || sku) AS hh FROM items)",
        "sz AS (SELECT product_type, count(*) AS n FROM h GROUP BY product_type)",
        f"tot AS (SELECT sum(n) AS nn, cast(ceil({test_size} * sum(n)) AS bigint) AS nt FROM sz)",
        "al AS (SELECT product_type, n, floor(n * (nn - nt) / nn) AS fl, "
        "n * (nn - nt) / nn - floor(n * (nn - nt) / nn) AS rem FROM sz, tot)",
        "ex AS (SELECT product_type, row_number() OVER (ORDER BY rem DESC, product_type) AS rk FROM al)",
        "alloc AS (SELECT al.product_type, al.n - (al.fl + CASE WHEN ex.rk <= (SELECT nn - nt FROM tot) - "
        "(SELECT sum(fl) FROM al) THEN 1 ELSE 0 END) AS n_test FROM al JOIN ex USING (product_type))",
        "splitted AS (SELECT h.* EXCLUDE (hh), CASE WHEN row_number() OVER (PARTITION BY h.product_type "
        "ORDER BY hh, sku) <= alloc.n_test THEN 'test' ELSE 'train' END AS split FROM h JOIN alloc USING (product_type))",
    ]


def knn_ctes(k: int = 5) -> list[str]:
    d2 = " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in KNN_FEATURES)
    return split_ctes() + [
        f"pairs AS (SELECT q.sku AS q_sku, t.sku AS t_sku, t.lead_time AS t_label, {d2} AS d2 "
        f"FROM splitted q CROSS JOIN (SELECT * FROM splitted WHERE split = 'train') t)",
        f"nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_sku ORDER BY d2, t_sku) AS rn "
        f"FROM pairs) WHERE rn <= {k})",
        "knn AS (SELECT s.sku, s.split, s.lead_time AS label, p.prediction FROM splitted s JOIN "
        "(SELECT q_sku AS sku, avg(t_label) AS prediction FROM nn GROUP BY q_sku) p USING (sku))",
        "metrics AS (SELECT split, count(*) AS n, round(sqrt(sum((label - prediction) * (label - prediction)) / count(*)), 6) AS rmse, "
        "round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2, "
        "round(sum(abs(label - prediction)) / count(*), 6) AS mae FROM knn GROUP BY split)",
    ]


def _cut_sql(x: str) -> str:
    parts = [f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'"
             for lo, hi, lab in zip(DEFECT_BIN_EDGES[:-1], DEFECT_BIN_EDGES[1:], DEFECT_BIN_LABELS)]
    return "CASE " + " ".join(parts) + " END"


def features_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["log_features"] = with_fact(
        "SELECT sku, " + ", ".join(f"round(ln(1 + {D(c)}), 6) AS {c}_log"
                                   for c in ("production_volumes", "costs", "revenue_generated")) + " FROM fact")
    q["interaction_features"] = with_fact(
        f"SELECT sku, {D('defect_rates')} * {D('production_volumes')} AS defect_production_interaction, "
        f"{D('price')} * {D('order_quantities')} AS price_order_interaction FROM fact")
    q["ratio_features"] = with_fact(
        f"SELECT sku, ({D('revenue_generated')} - {D('costs')}) / {z1('revenue_generated')} AS profit_margin, "
        f"{D('order_quantities')} / {z1('stock_levels')} AS inventory_turnover_ratio FROM fact")
    q["squared_features"] = with_fact(
        "SELECT sku, " + ", ".join(f"{D(c)} * {D(c)} AS {c}_squared"
                                   for c in ("defect_rates", "production_volumes", "price")) + " FROM fact")
    q["cut_bins"] = with_fact(f"SELECT sku, {D('defect_rates')} AS defect_rates, "
                              f"{_cut_sql(D('defect_rates'))} AS defect_rate_category FROM fact")
    e = [f"quantile_cont({D('production_volumes')}, {p})" for p in (0, 0.25, 0.5, 0.75, 1)]
    L = VOLUME_QUARTILE_LABELS
    q["quartile_bins"] = with_fact(
        f"""SELECT sku, x AS production_volumes, CASE WHEN x >= e0 AND x <= e1 THEN '{L[0]}'
  WHEN x > e1 AND x <= e2 THEN '{L[1]}' WHEN x > e2 AND x <= e3 THEN '{L[2]}'
  WHEN x > e3 AND x <= e4 THEN '{L[3]}' END AS production_volume_category
FROM (SELECT sku, {D('production_volumes')} AS x FROM fact) CROSS JOIN edges""",
        "edges AS (SELECT " + ", ".join(f"{x} AS e{i}" for i, x in enumerate(e)) + " FROM fact)")
    q["efficiency"] = with_fact(f"SELECT sku, {D('production_volumes')} / {z1('manufacturing_lead_time')} "
                                f"AS manufacturing_efficiency FROM fact")
    enc = [f"e_{c} AS (SELECT {c} AS v, {M('lead_time')} AS m FROM fact WHERE {c} IS NOT NULL GROUP BY {c})"
           for c in ENC_COLS]
    q["target_encode_all"] = with_fact(
        "SELECT f.sku, " + ", ".join(f"e_{c}.m AS {c}_lead_time_mean" for c in ENC_COLS) + " FROM fact f "
        + " ".join(f"LEFT JOIN e_{c} ON f.{c} = e_{c}.v" for c in ENC_COLS), *enc)
    for key in ("product_type", "location", "sku"):
        q[f"encode_{key}"] = with_fact(f"SELECT {key}, {M('lead_time')} AS {key}_lead_time_mean "
                                       f"FROM fact GROUP BY {key}")
    views = [f"{k}_encoding AS (SELECT {k}, {M('lead_time')} AS {k}_lead_time_mean FROM fact GROUP BY {k})"
             for k in ("product_type", "location", "sku")]
    base = ", ".join(f"sc.{n}" for n, _ in FACT_COLUMNS)
    joins = ("LEFT JOIN product_type_encoding pte ON sc.product_type = pte.product_type "
             "LEFT JOIN location_encoding le ON sc.location = le.location "
             "LEFT JOIN sku_encoding se ON sc.sku = se.sku")
    q["encoded_fact"] = with_fact(
        f"SELECT {base}, pte.product_type_lead_time_mean, le.location_lead_time_mean, se.sku_lead_time_mean "
        f"FROM fact sc {joins}", *views)
    q["ml_ready"] = with_fact(
        f"""SELECT sc.sku, sc.product_type, {D('sc.price')} AS price, {D('sc.defect_rates')} AS defect_rates,
  sc.production_volumes, {D('sc.manufacturing_costs')} AS manufacturing_costs,
  {D('sc.shipping_costs')} AS shipping_costs, sc.lead_time, pte.product_type_lead_time_mean,
  le.location_lead_time_mean, se.sku_lead_time_mean,
  CASE sc.transportation_modes WHEN 'Air' THEN 1 WHEN 'Road' THEN 2 WHEN 'Sea' THEN 3 WHEN 'Rail' THEN 4 ELSE 0 END
    AS transport_mode_code,
  CAST(CASE sc.inspection_results WHEN 'Pass' THEN 1 WHEN 'Fail' THEN 0 ELSE 0.5 END AS double) AS inspection_score
FROM fact sc {joins}""", *views)
    zs = [("defect_rates", "defect_rate_z"), ("production_volumes", "production_volume_z"),
          ("price", "price_z"), ("shipping_costs", "shipping_cost_z")]
    stats = ", ".join(f"{M(c)} AS mu_{c}, stddev_pop({D(c)}) AS sd_{c}" for c, _ in zs)
    q["zscore_features"] = with_fact(
        "SELECT sku, " + ", ".join(f"round(({D(c)} - mu_{c}) / nullif(sd_{c}, 0), 6) AS {z}" for c, z in zs)
        + ", lead_time FROM fact CROSS JOIN st", f"st AS (SELECT {stats} FROM fact)")
    cf = ["defect_rates", "production_volumes", "price", "shipping_costs", "lead_time"]
    stats5 = ", ".join(f"{M(c)} AS mu_{c}, stddev_pop({D(c)}) AS sd_{c}" for c in cf)
    q["standard_scale"] = with_fact(
        "SELECT sku, " + ", ".join(f"round(({D(c)} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1.0 ELSE sd_{c} END, 6) "
                                   f"AS {c}_scaled" for c in cf)
        + " FROM fact CROSS JOIN st", f"st AS (SELECT {stats5} FROM fact)")
    q["sku_items"] = with_fact("SELECT * FROM items", *items_ctes())
    # long dummies: every level but the first of its column; bins have fixed first labels
    cats = [c for c in STRING if c != "sku"]
    first = {c: f"(SELECT min({c}) FROM binned)" for c in cats} | {
        "defect_rate_category": f"'{DEFECT_BIN_LABELS[0]}'", "production_volume_category": f"'{L[0]}'"}
    q["one_hot_drop_first"] = with_fact(
        " UNION ALL ".join(f"SELECT sku, '{c}_' || {c} AS feature, 1 AS value FROM binned WHERE {c} <> {lv}"
                           for c, lv in first.items()),
        *items_ctes(), "edges AS (SELECT " + ", ".join(f"{x} AS e{i}" for i, x in enumerate(e)) + " FROM items)",
        f"""binned AS (SELECT items.*, {_cut_sql(D('defect_rates'))} AS defect_rate_category,
  CASE WHEN production_volumes >= e0 AND production_volumes <= e1 THEN '{L[0]}'
  WHEN production_volumes > e1 AND production_volumes <= e2 THEN '{L[1]}'
  WHEN production_volumes > e2 AND production_volumes <= e3 THEN '{L[2]}'
  WHEN production_volumes > e3 AND production_volumes <= e4 THEN '{L[3]}' END AS production_volume_category
FROM items CROSS JOIN edges)""")
    q["stratified_split"] = with_fact("SELECT sku, product_type, split FROM splitted", *split_ctes())
    q["split_sizes"] = with_fact("SELECT split, product_type, count(*) AS n FROM splitted GROUP BY ALL",
                                 *split_ctes())
    q["knn_regression"] = with_fact("SELECT sku, split, label, round(prediction, 6) AS prediction FROM knn",
                                    *knn_ctes())
    q["regression_metrics"] = with_fact("SELECT * FROM metrics", *knn_ctes())
    q["overfit_pct"] = with_fact(
        """SELECT a.r2 AS train_r2, b.r2 AS test_r2,
  CASE WHEN a.r2 = 0 THEN 0.0 ELSE round((a.r2 - b.r2) / a.r2 * 100, 6) END AS overfit_pct
FROM (SELECT r2 FROM metrics WHERE split = 'train') a CROSS JOIN (SELECT r2 FROM metrics WHERE split = 'test') b""",
        *knn_ctes())
    return q
