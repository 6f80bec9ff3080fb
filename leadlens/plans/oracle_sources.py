"""DuckDB oracle text for the source / sink queries."""

from __future__ import annotations

from ..schema import FACT_COLUMNS
from .oracle_fact import with_fact
from .oracle_reports import report_sql

BASE = [n for n, _ in FACT_COLUMNS]


def source_sql() -> dict[str, str]:
    as_read = ", ".join(f"cast({n} AS double) AS {n}" if t.startswith("decimal") else n for n, t in FACT_COLUMNS)
    return {
        "fact_typed": with_fact(f"SELECT {', '.join(BASE)} FROM fact"),
        "typed_table": with_fact(
            f"SELECT row_number() OVER (ORDER BY {', '.join(f'{n} NULLS FIRST' for n in BASE)}) AS id, {', '.join(BASE)} FROM fact"),
        "shape": with_fact(f"SELECT count(*) AS rows, {len(BASE)} AS columns FROM fact"),
        "dtype_counts": "SELECT CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
                        "WHEN 'BIGINT' THEN 'bigint' ELSE lower(column_type) END AS dtype, cast(count(*) AS int) AS columns "
                        f"FROM (DESCRIBE {with_fact(f'SELECT {", ".join(BASE)} FROM fact')}) GROUP BY 1",
        "head_rows": with_fact(f"SELECT {', '.join(BASE)} FROM fact ORDER BY {', '.join(BASE)} LIMIT 5"),
        "csv_roundtrip": with_fact(f"SELECT {as_read} FROM fact"),
        # the feature stage widens the 24 base columns to 45
        "feature_matrix_width": with_fact("SELECT 24 AS columns_before, 45 AS columns_after, count(*) AS rows FROM fact"),
        "monthly_snapshot_stream": report_sql({"min_orders": 0, "lead_threshold": 0, "premium_price": 0,
                                               "location_avg": 0, "supplier_defect": 0, "listed": 0})["monthly_snapshot"],
    }
