"""A packing task looks up the words of a bounded stretch of text at a time."""

from __future__ import annotations

from leadlens.llm import packing


def test_words_are_looked_up_by_bounded_stretches(monkeypatch):
    seen, plain = [], packing.coded

    def counting(group):
        seen.append(sum(map(len, group)))
        return plain(group)

    monkeypatch.setattr(packing, "coded", counting)
    texts = [" ".join(f"word{i % 50} number" for i in range(20_000))] * 12       # some 3 million letters
    ids = packing.TextIds(packing.vocabulary_path())
    got = list(ids.texts(texts))
    assert len(set(got)) == 1 and got[0] == packing.id_bytes(
        ids.tokenizer.encode(texts[0], add_special_tokens=False).ids)
    assert max(seen) <= 1_000_000 + len(texts[0]) and sum(seen) == sum(map(len, texts))


def test_a_word_is_looked_up_once_in_each_cache(monkeypatch):
    """Known words cost one look-up, words of the older half and new ones one more."""
    ids = packing.TextIds(packing.vocabulary_path())
    alone = lambda w: packing.id_bytes(ids.tokenizer.encode(w, add_special_tokens=False).ids)
    first = ["plain", "Mixed", "stops...", "x2", "é", "naïve,", "a" * 65, "b" * 70 + "!", "end."]
    assert ids.known(first) == list(map(alone, first))
    assert "plain" in ids and "a" * 65 not in ids
    monkeypatch.setattr(packing.TextIds, "limit", 1)
    met = []
    monkeypatch.setattr(ids, "several", lambda new: met.append(list(new)) or [alone(w) for w in new])
    again = ["new", "plain", "a" * 65, "x2", "other"]
    assert ids.known(again) == list(map(alone, again))
    assert met == [["new", "a" * 65, "other"]] and set(ids) == {"new", "plain", "x2", "other"}


def test_packing_reads_texts_from_arrow(spark):
    rows = [(2**60 + 1, "one two"), (None, None), (3, "")] + [(k, "word " * 5000) for k in range(4, 8)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()
    totals = {}
    for r in out.collect():
        totals[r.doc_id] = totals.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.length
    assert totals == {2**60 + 1: 3, None: 1, 3: 1, **{k: 5001 for k in range(4, 8)}}
