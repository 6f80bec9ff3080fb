"""Hosts on both sides of the bound: the verdict reaches their documents, and
the whole result equals the SQL."""

import duckdb
import pandas as pd

from leadlens.llm import quality_rules


def _hosts() -> pd.DataFrame:
    """Forty clean hosts, one of 198 documents full of symbols and 2 clean ones,
    one of 2 documents that both fail, and documents without a host."""
    clean = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    junk = lambda k: " ".join(f"a####{j}" for j in range(60 + k % 3))
    rows = [(f"host{k % 40}", clean(k)) for k in range(800)]
    rows += [("bad", junk(k)) for k in range(198)] + [("bad", clean(9000)), ("bad", clean(9001))]
    rows += [("small", junk(1)), ("small", junk(2)), (None, clean(9002)), (None, "few words")]
    return pd.DataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], columns=["doc_id", "source", "text"])


def test_failing_hosts_go_and_small_ones_are_shrunk(spark):
    documents = _hosts()
    docs = spark.createDataFrame([tuple(r) for r in documents.astype(object).where(documents.notna(), None).values],
                                 "doc_id long, source string, text string").repartition(5)
    got = {r.doc_id: r for r in quality_rules.quality(docs).collect()}
    bad = set(documents.doc_id[documents.source == "bad"])
    small = set(documents.doc_id[documents.source == "small"])
    assert {i for i, r in got.items() if r.host_failed} == bad
    assert not any(got[i].base_failed or got[i].kept for i in bad)      # only the host's verdict rejects them
    assert all(got[i].kept for i in small)                               # two failures are not enough
    kept = {r.doc_id for r in quality_rules.keep_quality(docs).collect()}
    assert kept == set(range(len(documents))) - bad - {len(documents) - 1}

    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(quality_rules.ORACLE)
    cols = [c[0] for c in want.description]
    assert sorted(want.fetchall()) == sorted(tuple(getattr(r, c) for c in cols) for r in got.values())
