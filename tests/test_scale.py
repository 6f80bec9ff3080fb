"""What crosses the network: rows and partial rows of the shared steps."""

from __future__ import annotations

import pytest

from leadlens.schema import FACT_COLUMNS, fact_struct
from leadlens.sources.fact import build_fact, items

from .conftest import SF_SMALL


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _below(lines: list[str], at: int, word: str) -> list[str]:
    """The lines of the subtree under line ``at``, whose node is ``word``."""
    depth, out = lines[at].index(word), []
    for line in lines[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        out.append(line)
    return out


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_lines_are_not_shuffled_for_customers(spark, no_broadcast):
    lines = _plan(build_fact(spark, SF_SMALL))
    found = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in x]
    assert found
    for i in found:
        below = _below(lines, i, "Exchange")
        assert any("o_orderkey" in x for x in below) and not any("l_orderkey" in x for x in below)


def _rows(spark):
    kinds = {"string": lambda k: f"v{k}", "int": lambda k: k}
    out = []
    for sku, n in (("a", 7), ("b", 1), (None, 5), ("c", 3)):
        for i in range(n):
            row = []
            for c, t in FACT_COLUMNS:
                v = kinds[t](i % 3) if t in kinds else None if i == 1 else (i * 7 % 5)
                row.append(sku if c == "sku" else v)
            out.append(tuple(row))
    wide = spark.createDataFrame(out, ", ".join(f"{n} {'string' if t == 'string' else 'int'}" for n, t in FACT_COLUMNS))
    return wide.select(*[wide[f.name].cast(f.dataType) for f in fact_struct()])


def test_items_send_rows_and_not_partial_modes(spark, no_broadcast):
    lines = _plan(items(_rows(spark)))
    shuffle = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(sku" in x)
    assert not any("Aggregate" in x for x in lines[shuffle:])


@pytest.mark.parametrize("heavy_rows", [0, 2, 4, 6])
def test_items_with_heavy_skus_are_the_same(spark, heavy_rows):
    rows = _rows(spark)
    key = lambda r: (r.sku is None, r.sku or "")
    want, got = (sorted(items(rows, n).collect(), key=key) for n in (1_000_000, heavy_rows))
    assert want == got and [r.sku for r in got] == ["a", "b", "c", None]
