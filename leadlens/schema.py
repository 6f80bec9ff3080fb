"""Typed layout of the supply-chain fact relation and fixed values.

The column list, SQL types and label orders below are fixed values that
results must agree on; they are listed in natural (table) order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: base table columns and their declared SQL types -------
FACT_COLUMNS = [
    ("product_type", "string"),
    ("sku", "string"),
    ("price", "decimal(10,2)"),
    ("availability", "int"),
    ("number_of_products_sold", "int"),
    ("revenue_generated", "decimal(12,2)"),
    ("customer_demographics", "string"),
    ("stock_levels", "int"),
    ("lead_times", "int"),
    ("order_quantities", "int"),
    ("shipping_times", "int"),
    ("shipping_carriers", "string"),
    ("shipping_costs", "decimal(10,2)"),
    ("supplier_name", "string"),
    ("location", "string"),
    ("lead_time", "int"),
    ("production_volumes", "int"),
    ("manufacturing_lead_time", "int"),
    ("manufacturing_costs", "decimal(12,2)"),
    ("inspection_results", "string"),
    ("defect_rates", "decimal(5,2)"),
    ("transportation_modes", "string"),
    ("routes", "string"),
    ("costs", "decimal(12,2)"),
]

# The CSV header names, in file order (normalised name = lower, ' ' -> '_').
CSV_HEADERS = [
    "Product type", "SKU", "Price", "Availability", "Number of products sold",
    "Revenue generated", "Customer demographics", "Stock levels", "Lead times",
    "Order quantities", "Shipping times", "Shipping carriers", "Shipping costs",
    "Supplier name", "Location", "Lead time", "Production volumes",
    "Manufacturing lead time", "Manufacturing costs", "Inspection results",
    "Defect rates", "Transportation modes", "Routes", "Costs",
]

# ---- fixed values: tokens pandas reads as missing ------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ---- fixed values: label orders and thresholds ---------------------------
TARGET = "lead_time"
DEFECT_BIN_EDGES = [0, 1, 2, 3, 5, 10]
DEFECT_BIN_LABELS = ["Very Low", "Low", "Medium", "High", "Very High"]
VOLUME_QUARTILE_LABELS = ["Low", "Medium", "High", "Very High"]
TRANSPORT_CODES = [("Air", 1), ("Road", 2), ("Sea", 3), ("Rail", 4)]  # else 0
INSPECTION_SCORES = [("Pass", 1.0), ("Fail", 0.0)]  # else 0.5
CLUSTER_FEATURES = ["defect_rates", "production_volumes", "price", "shipping_costs", "lead_time"]
ZSCORE_FEATURES = [("defect_rates", "defect_rate_z"), ("production_volumes", "production_volume_z"),
                   ("price", "price_z"), ("shipping_costs", "shipping_cost_z")]
LOG_FEATURES = ["production_volumes", "costs", "revenue_generated"]
SQUARED_FEATURES = ["defect_rates", "production_volumes", "price"]


def sql_type(t: str) -> T.DataType:
    if t.startswith("decimal"):
        p, s = t[8:-1].split(",")
        return T.DecimalType(int(p), int(s))
    return {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
            "bigint": T.LongType()}[t]


def fact_struct() -> T.StructType:
    """StructType of the typed base table (all nullable)."""
    return T.StructType([T.StructField(n, sql_type(t), True) for n, t in FACT_COLUMNS])


def csv_struct() -> T.StructType:
    """Raw-model schema for the CSV (int / double / string, as inferred)."""
    kinds = {"string": T.StringType(), "int": T.IntegerType()}
    fields = []
    for header, (_, t) in zip(CSV_HEADERS, FACT_COLUMNS):
        fields.append(T.StructField(header, kinds.get(t, T.DoubleType()), True))
    return T.StructType(fields)


NUMERIC_COLUMNS = [n for n, t in FACT_COLUMNS if t != "string"]
STRING_COLUMNS = [n for n, t in FACT_COLUMNS if t == "string"]
