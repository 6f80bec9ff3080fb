"""Token alignment against a brute-force alignment of the library tokens, hard
negatives against plain integer products, exact dedup against grouping by
normalised text; odd tables for each."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import bpe, exact_dedup, hard_negatives, token_alignment

SF = "/root/testdata/sf0.001"
BIG = 2**53 + 1
DOCS = "doc_id long, text string, r string, pair string, block string, salt string"
ODD = ["a▁b", " lead", "two  sp x", "\ttab\n\nx", "<s>hi</s><unk>", "<0x41>", "日本語 é ﬁ", "\xa0x y\xa0 z", " ", "\n",
       "a\r\nb", "x​z q", "\U0001f600 a.b,c", "<|endoftext|> x", "é Ａ", "a.\nB,c\nd\n e \n", "don't 's 't x's.",
       "a\x1cb \x85c  d", "x ² y².z Ⅷ.", "end ", "3.14,5 .a ,b", "word," + "." * 50, "x\n\ny\n", "same words " * 4000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (BIG, "big id"), (100, None), (101, ""), (3, ODD[3]),
                                                 (102, "same words " * 4000), (None, "no id"), (BIG + 1, "big  id")]
    return spark.createDataFrame([(i, t, "r", "p", "b", "s") for i, t in rows], DOCS).repartition(3)


# ---- token alignment ---------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizers_ab():
    import sentencepiece
    import tokenizers
    a = tokenizers.Tokenizer.from_file(bpe.vocabulary_path(token_alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path(token_alignment.VOCABULARY_B))


def brute_alignment(tokenizers_ab, text):
    """(n_a, n_b, n_groups, digest, links) token by token; zeros if not covered."""
    a, b = tokenizers_ab
    if not text:
        return 0, 0, 0, "", []
    letters = {x: k for k, x in enumerate(bpe.byte_letters())}
    got = a.encode(" " + text, add_special_tokens=False)
    ids_a, ids_b = got.ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in x) for x in got.tokens]
    pieces = [b.id_to_piece(k) for k in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(ids_b, pieces)]
    raw = (" " + text).encode()
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return 0, 0, 0, "", []
    of_byte = [[k for k, x in enumerate(xs) for _ in x] for xs in (bytes_a, bytes_b)]
    pairs = sorted(set(zip(*of_byte)))
    ends = [set(np.cumsum([len(x) for x in xs]).tolist()) for xs in (bytes_a, bytes_b)]
    groups, start = [], 0
    for end in sorted(ends[0] & ends[1]):
        groups.append("|".join(",".join(str(ids[k]) for k in dict.fromkeys(of[start:end]))
                               for ids, of in zip((ids_a, ids_b), of_byte)))
        start = end
    return (len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(),
            [(ids_a[x], ids_b[y]) for x, y in pairs])


def check_alignment(tokenizers_ab, docs):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [(i, brute_alignment(tokenizers_ab, t)) for i, t in texts]
    docs_of = Counter(p for _, x in found for p in set(x[4]))
    most = defaultdict(int)
    for (a, _), n in docs_of.items():
        most[a] = max(most[a], n)
    want = [(i, *x[:3], len(x[4]), sum(docs_of[p] == most[p[0]] for p in x[4]), sum(docs_of[p] for p in x[4]), x[3])
            for i, x in found]
    got = [tuple(r) for r in token_alignment.alignment(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_alignment_of_documents(spark, tokenizers_ab):
    check_alignment(tokenizers_ab, spark.read.parquet(f"{SF}/documents.parquet"))


def test_alignment_of_odd_rows_over_several_blocks(odd, tokenizers_ab, monkeypatch):
    check_alignment(tokenizers_ab, odd)
    assert token_alignment.alignment(odd.where("false")).count() == 0


def test_alignment_of_random_texts(tokenizers_ab):
    aligner = token_alignment.aligner_of(*map(bpe.vocabulary_path, (token_alignment.VOCABULARY_A, token_alignment.VOCABULARY_B)))
    rng, letters = random.Random(7), [*"ab cé.,\n\n  '1²x▁日\t-", "th", "lead "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    for t, (n_a, n_b, groups, n_links, digest, held, times) in zip(texts, aligner.documents(texts), strict=True):
        want = brute_alignment(tokenizers_ab, t)
        assert (n_a, n_b, groups, digest) == want[:4], t
        pairs = Counter({(int(p) // aligner.base, int(p) % aligner.base): int(n) for p, n in zip(held, times)})
        assert pairs == Counter(want[4]) and n_links == len(want[4])


def test_tokenizer_a_is_the_file_s(tokenizers_ab):
    aligner = token_alignment.aligner_of(*map(bpe.vocabulary_path, (token_alignment.VOCABULARY_A, token_alignment.VOCABULARY_B)))
    points = [c for c in range(1, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    texts = [f"x{chr(c)}y 1{chr(c)}2 .{chr(c)}! {chr(c)}{chr(c)} z" for c in points]
    for t, x in zip(texts, tokenizers_ab[0].encode_batch(texts, add_special_tokens=False)):
        assert aligner.a.encode_ordinary(t) == x.ids


def test_pointer_doubling_on_long_chains():
    # A's tokens end at even offsets, B's at odd ones: one component to the end
    a, b = np.arange(2, 2001, 2), np.append(np.arange(1, 2000, 2), 2000)
    of_a, of_b = token_alignment.components(a, b)
    assert set(of_a.tolist()) | set(of_b.tolist()) == {len(b) - 1}


# ---- hard negatives ----------------------------------------------------------

def brute_negatives(rows):
    use = []
    for vec_id, label, v in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        use.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, (a_id, a_label, a) in enumerate(use):
        if a_id is None or a_id % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), i, lab) for j, (i, lab, v) in enumerate(use) if j != k and len(v) == len(a)]
        for p, p_id, _ in sorted((s for s in scored if s[2] == a_label), key=order)[:5]:
            fit = sorted((s for s in scored if s[2] != a_label and 50 * p <= 100 * s[0] <= 95 * p), key=order)[:3]
            out += [(a_id, p_id, r, n_id, p, n) for r, (n, n_id, _) in enumerate(fit, 1)]
    return sorted(map(repr, out))


def vectors(spark, rows):
    return spark.createDataFrame([(i, lab, v, "r", "x") for i, lab, v in rows],
                                 "vec_id long, label int, embedding array<float>, r string, planes string")


def test_negatives_against_plain_products(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, int(rng.integers(0, 3)), rng.normal(0, 1, 11).round(1).tolist()) for k in range(240)]
    rows += [(50, 1, rows[3][2]), (50, 1, rows[3][2]), (None, 1, rows[4][2]), (300, None, rows[4][2]), (350, 2, None),
             (400, 1, [float("nan")] * 11), (450, 1, [float("inf")] * 11), (500, 1, [None] + [1.0] * 10),
             (550, 1, [1.0, 2.0]), (551, 1, [1.0, 1.0]), (552, 2, [0.5, 1.0]), (600, 0, []), (601, 0, []), (602, 1, []),
             (650, 1, [3.0e4] * 11), (651, 1, [2.0e4] * 11), (652, 2, [1.5e4] * 11), (BIG - BIG % 50, 3, [1.0] * 11),
             (BIG, 3, [1.0] * 11), (BIG + 1, 4, [0.75] * 11)]
    got = hard_negatives.mine(vectors(spark, rows).repartition(3))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_negatives(rows)
    assert hard_negatives.mine(vectors(spark, rows).where("false")).count() == 0


def test_negatives_over_many_blocks_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 2)
    monkeypatch.setattr(hard_negatives, "ROW_ROWS", 40)
    rng = np.random.default_rng(6)
    hot = rng.normal(0, 1, 16).tolist()
    rows = [(k, k % 4, hot if k % 3 == 0 else (np.array(hot) * rng.uniform(0.4, 1)).tolist()) for k in range(400)]
    assert sorted(repr(tuple(r)) for r in hard_negatives.mine(vectors(spark, rows)).collect()) == brute_negatives(rows)


def test_four_russians_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for low, high, dims in ((-200, 200, 64), (0, 1, 3), (-(2**29), 2**29, 9), (-1, 0, 8)):
        x, y = rng.integers(low, high, (70, dims)), rng.integers(low, high, (5, dims))
        planes = hard_negatives.unpack([hard_negatives.bit_planes(v) for v in x], dims)
        own = hard_negatives.components(hard_negatives.unpack([hard_negatives.bit_planes(v) for v in y], dims), dims)
        assert (own[:, :dims] == y).all()
        kind = hard_negatives.fits(own, hard_negatives.components(planes, dims))
        assert (hard_negatives.scores(hard_negatives.subset_sums(own, kind), planes) == y @ x.T).all()


# ---- exact dedup -------------------------------------------------------------

def check_exact(docs, **kw):
    rows = [(r.doc_id, re.sub("[\x20\x09-\x0d]+", " ", r.text or "")) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want, stays = [], Counter()
    for i, t in rows:
        ids = groups[t]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()))
        stays[t] += 0
    got = exact_dedup.dedup(docs, **kw).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == sorted(map(repr, want))
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_on_odd_rows(spark, odd):
    check_exact(odd)
    assert exact_dedup.dedup(odd.where("false")).count() == 0
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == exact_dedup.dedup(odd).where("kept").count()


def test_exact_dedup_when_chunk_hashes_clash(spark, odd):
    long = [" ".join(f"w{k}{'.' if k % 7 == 0 else ''}" for k in range(n)) for n in (3000, 3001, 3000)]
    docs = odd.select("doc_id", "text").unionAll(spark.createDataFrame(list(enumerate(long, 500)), "doc_id long, text string"))
    weak = lambda c: F.struct((F.xxhash64(c) % 3).alias("a"), F.lit(0).cast("long").alias("b"))
    check_exact(docs, hashed=weak)
    assert exact_dedup.chunk_dictionary(docs, weak).where("texts > 1").count() > 0


def test_chunks_join_to_the_text(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").unionAll(odd.select("text"))
    norm = exact_dedup.normalised(F.col("text"))
    bad = docs.where(F.array_join(exact_dedup.chunks(norm), "") != norm)
    sizes = docs.select(F.explode(exact_dedup.chunks(norm)).alias("c")).agg(F.max(F.length("c"))).first()[0]
    assert bad.count() == 0 and sizes <= exact_dedup.MOST
