"""Ids above 2^53 beside nulls, and repeated ids with other texts."""

import pytest

from leadlens.llm import bpe, language_id, ngram_join, packing

BIG = 2**53 + 1


def words(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


@pytest.fixture(scope="module")
def big(spark):
    return spark.createDataFrame([(BIG, "some words of a text"), (None, "other words"), (BIG + 2, "more words of a text")],
                                 "doc_id long, text string").coalesce(1)


def found(df):
    return sorted({r.doc_id for r in df.collect() if r.doc_id is not None})


def test_ids_above_2_53_beside_a_null(big):
    assert found(ngram_join.jaccard_components(big)) == [BIG, BIG + 2]
    assert {r.component_id for r in ngram_join.jaccard_components(big).collect()} == {None, BIG, BIG + 2}
    assert found(bpe.digests(big)) == found(bpe.encode(big)) == [BIG, BIG + 2]
    assert found(packing.pack(big)) == [BIG, BIG + 2]
    model = language_id.learn(big.selectExpr("doc_id", "text", "'en' AS lang"))
    got = language_id.predict(big.selectExpr("doc_id", "text", "doc_id AS other"), model)
    assert found(got) == [BIG, BIG + 2] and got.columns == ["doc_id", "other", "lang_pred", "score"]


@pytest.mark.parametrize("turn", [1, -1])
def test_an_id_with_two_texts_links_both(spark, turn):
    a, b = words("a", 60), words("b", 60)
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, words("c", 60))][::turn]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
