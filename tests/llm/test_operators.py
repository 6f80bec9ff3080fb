"""Training-data operators against DuckDB, brute force and planted cases,
and on odd tables: nulls, empty and long texts, repeated rows, no rows,
extra columns with clashing names."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import (bpe, embedding_dedup, language_id, license_scan, line_dedup, ngram_join, packing,
                          quality_rules, registry, substring_dedup, warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, rep string, component string"
PASSAGE = " ".join(f"passage{k}" for k in range(60))


def words(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    long = words("long", 30_000)
    rows = [(1, words("a", 80)), (2, words("a", 80)), (3, words("a", 79) + " other"), (4, None), (5, ""), (6, " \n\t "),
            (7, words("b", 60) + " " + PASSAGE + " tail of seven"), (8, words("c", 60) + ". " + PASSAGE + "\nend"),
            (9, long), (10, "Permission MIT\nunder the MIT license, cc by nc"), (10, "Permission MIT\nunder the MIT license, cc by nc"),
            (None, words("a", 80)), (11, "x " * 60 + "<|endoftext|> É ß"), (12, "### *** 12 34 !!")]
    return spark.createDataFrame([(i, t, "en" if i != 5 else None, None if i == 3 else "h", 1, "r", "q", "z") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


@pytest.mark.parametrize("name", sorted(registry.llm_oracles()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.llm_oracles()[name])
    cols = [c[0] for c in want.description]
    got = registry.llm_queries()[name](spark, SF).select(*cols).collect()
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(repr, map(key, want.fetchall()))) == sorted(map(repr, map(key, got)))


def test_quality_on_odd_rows(odd, none):
    rows = {r.doc_id: r for r in quality_rules.quality(odd).collect()}
    assert not rows[4].kept and rows[4].n_words == 0 and rows[1].n_words == 80
    assert rows[11].n_repeat_words == 60 and rows[11].base_failed
    kept = quality_rules.keep_quality(odd)
    assert kept.columns == odd.columns and 1 in [r.doc_id for r in kept.collect()]
    assert quality_rules.quality(none).count() == 0 and quality_rules.keep_quality(none).count() == 0


def test_license_on_odd_rows(odd, none):
    rows = {r.doc_id: r for r in license_scan.scan(odd).collect()}
    assert rows[10].base_labels == "cc-by-nc,mit" and rows[10].n_base == 2 and rows[10].score == 1.0
    assert (rows[10].first_word, rows[10].last_word) == (2, 6) and rows[4].labels == "" and rows[4].first_word is None
    assert license_scan.scan(odd).count() == odd.count() and license_scan.scan(none).count() == 0


def test_line_dedup_on_odd_rows(spark, odd, none):
    out = {r.doc_id: r for r in line_dedup.dedup_lines(odd).where("doc_id is not null").collect()}
    assert 1 in out and 2 not in out and 3 not in out          # equal, one word replaced
    assert out[4].text is None and out[5].text == "" and len(out[9].text) > 100_000
    assert line_dedup.dedup_lines(none).count() == 0 and line_dedup.dedup_lines(odd).columns == odd.columns
    base = words("w", 12).split()
    texts = [" ".join(base), " ".join(base[:4] + base[5:]), " ".join(base[:7] + ["new"] + base[7:]), " ".join(base[1:] + base[:1]),
             " ".join(base[:4] + base[6:]), "short line", "short line"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # 4 is one word from 1, which is one word from 0; 3 is two edits from all
    assert sorted(r.doc_id for r in line_dedup.removed_lines(d).collect()) == [1, 2, 4]


def test_ngram_join_brute_force(spark, odd, none):
    rng = np.random.default_rng(5)
    texts = {}
    for k in range(60):
        base = [f"w{x}" for x in rng.integers(0, 400, 120)]
        for c in range(int(rng.integers(1, 5))):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, len(own)))] = f"e{rng.integers(0, 9)}"
            texts[len(texts)] = " ".join(own)
    texts |= {1000: "a b", 1001: "A  b", 1002: "a b c", 1003: None, 1004: ""}
    sets = {i: {tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))} if (w := (t or "").lower().split()) else set()
            for i, t in texts.items()}
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((comp[a], comp[b]))
                comp = {i: x if c == y else c for i, c in comp.items()}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(d).collect()}
    assert got == {i: (len(sets[i]), comp[i]) for i in sets} and len(set(comp.values())) < len(comp)
    out = ngram_join.jaccard_components(odd)
    by = {r.doc_id: r.component_id for r in out.where("doc_id is not null").collect()}
    assert by[2] == 1 and by[4] == 4 and by[5] == 5 and out.count() == odd.count()
    assert ngram_join.jaccard_components(none).count() == 0
    kept = ngram_join.keep_representatives(odd)
    assert kept.columns == odd.columns and 2 not in [r.doc_id for r in kept.collect()]


def test_units_meet_all_pairs(spark):
    from leadlens.llm.shingles import units
    rows = spark.createDataFrame([("k", r) for r in range(40)], "key string, rep long")
    met = set()
    got = defaultdict(set)
    for r in units(rows, "key", 10).collect():
        got[r.b1, r.b2].add(r.rep)
    for s in got.values():
        met |= {(a, b) for a in s for b in s}
    assert len(met) == 1600 and len(got) > 1


def test_passages(odd, none):
    spans = substring_dedup.duplicate_spans(odd).collect()
    hit = {r.doc_id: r for r in spans}
    assert 8 in hit and hit[8].kept_doc_id == 7 and hit[8].length >= 40 and 7 not in hit and 9 not in hit
    out = {r.doc_id: r.text for r in substring_dedup.dedup_passages(odd).where("doc_id is not null").collect()}
    assert out[7] == odd.where("doc_id = 7").first().text and "passage30" not in out[8] and out[8].startswith("c0 c1")
    assert out[4] is None and out[5] == "" and 2 not in out
    assert substring_dedup.dedup_passages(none).count() == 0 and substring_dedup.dedup_passages(odd).columns == odd.columns


def test_bpe_equals_the_library(spark, odd, none):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.vocabulary_path())
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    rows += [(100 + k, t) for k, t in enumerate(["ΑΣ ΣΑΣ İstanbul", "it's we're'll 'tis", "a" * 99, "\x1c\x85\xa0x y", "漢字🙂 é é ﬁ"])]
    rows += [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(d).collect()]
    assert sorted(got) == sorted(want) and bpe.digests(none).count() == 0


def test_packing(odd, none):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.vocabulary_path())
    rows = packing.pack(odd).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for r in odd.where("doc_id is not null and doc_id <> 10").collect():
        want = [*library.encode(r.text or "", add_special_tokens=False).ids, packing.END]
        at = 0
        for p in sorted(docs[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want)
            assert p.ids_crc32 == zlib.crc32(np.array(want[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(want)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096 and at & (at - 1) == 0                # whole, or a power of two
    assert packing.pack(none).count() == 0


def test_embeddings_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + 0.08 * rng.normal(size=(40, 16)) for c in centres] + [rng.normal(size=(200, 16))])
    rows = [(k, [float(v) for v in np.float32(y)]) for k, y in enumerate(x)]
    bad = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [None] * 16), (9004, []), (9005, [1.0])]
    t = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    y = np.array([r[1] for r in rows])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    links = (y @ y.T >= 0.9) & ~np.eye(len(y), dtype=bool)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(t).collect()}
    n = np.array([got[k].n_links for k in range(len(y))])
    assert (n <= links.sum(axis=1)).all() and n.sum() >= 0.99 * links.sum() > 0
    assert all(got[k].n_links == 0 and got[k].kept for k in range(9000, 9006))
    assert embedding_dedup.near_duplicates(t.where("false")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, None), (4, "u", "\r\n\r\nWARC/1.1\r\n\r\né" * 50),
             (5, "u", ""), (None, "u", "same"), (7, "u", "x" * 200_000)]
    t = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archives(t, str(tmp_path / "w"))
    rows = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    by = {r.metadata.fields["page-id"]: r for r in rows}
    assert len(rows) == 7 and all(r.request is not None for r in rows)
    assert by["1"].response.record_type == "revisit" and by["1"].response.refers_to == "<urn:page:2>"
    assert by["2"].response.payload == b"same" and by[""].response.record_type == "revisit"
    assert by["3"].response.refers_to == "<urn:page:5>" and bytes(by["4"].response.payload).decode() == pages[3][2]
    assert by["7"].response.payload_bytes == 200_000


def test_language(spark, odd, none):
    got = language_id.op10_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.where("lang = lang_pred").count() / got.count()
    assert right > 0.95
    model = language_id.learn(odd.where("lang is not null"))
    out = {r.doc_id: r for r in language_id.predict(odd.select("doc_id", "text"), model).collect()}
    assert out[4].lang_pred == "und" and out[6].lang_pred == "und" and out[1].lang_pred == "en" and out[12].lang_pred == "und"
    assert language_id.predict(odd.select("doc_id", "text"), language_id.learn(none)).where("lang_pred <> 'und'").count() == 0


def test_segmentations_by_brute_force():
    pieces = language_id.Pieces(bpe.vocabulary_path())
    p = np.random.default_rng(0).random(pieces.size) * 1e-3

    def total(x):
        n, out = len(x), 0.0
        for mask in range(1 << (n - 1)):
            at, prob = 0, 1.0
            for i in range(1, n + 1):
                if i == n or mask >> (i - 1) & 1:
                    t = (pieces.ends if i == n else pieces.mids).get(x[at:i])
                    prob *= p[t] if t is not None else 0.0
                    at = i
            out += prob
        return out

    for x in ("the", "hello", "stones", "a"):
        want = np.log(total(x))
        table = p[:, None]
        assert np.isclose(language_id.log_probability(pieces.arcs(x), table.tolist(), 1)[0], want)
        assert np.isclose(language_id.Lattice(pieces, [x]).log_probabilities(table)[0][0], want)


def test_pipeline_on_odd_rows(spark, odd):
    import corpus_pipeline as C
    docs = odd
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns, name
        docs = docs.checkpoint()
    left = {r.doc_id: r.text for r in docs.collect()}
    assert 9 in left and 1 in left and 2 not in left and 3 not in left and "passage30" not in left[8]
    assert C.STAGES[-1][1](spark, docs, SF).select(F.countDistinct("doc_id")).first()[0] == len([i for i in left if i is not None])


def test_prefixes_of_linked_sets_share_enough():
    """Two sets at or above the threshold share the needed number of prefix
    tokens under any order, at all sizes."""
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for _ in range(3000):
            both = int(rng.integers(1, 60))
            a, b = int(rng.integers(0, 8)), int(rng.integers(0, 8))
            if 100 * both < percent * (both + a + b):
                continue
            order = rng.permutation(both + a + b)
            x = np.sort(np.concatenate([order[:both], order[both:both + a]]))
            y = np.sort(np.concatenate([order[:both], order[both + a:]]))
            common = len(np.intersect1d(x[:ngram_join.prefix_length(len(x), percent)],
                                        y[:ngram_join.prefix_length(len(y), percent)]))
            assert common >= max(ngram_join.needed(len(x), percent), ngram_join.needed(len(y), percent))


def test_joined_words_have_the_ids_of_whole_texts():
    """Words encoded together equal the library on the whole text, for odd
    letters, stops, marks and specials too."""
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(bpe.vocabulary_path())
    tokens = packing.TextIds(bpe.vocabulary_path())
    assert tokens.last.any()
    texts = ["plain words, with stops. and! more? a; b: c", "İstanbul İ, ΣΑΣ σς Straße, ǅ ª º ﬁ", "étude ́a ́ é, 한국어 中文。",
             "don't can't, it's 12,5 x2 <|endoftext|> </w> a</w>b", "", None, " \t\n", "word" * 3000 + ", tail.", "\x1cdark\x1dmatter,\u2009line",
             "junk$$$ word&&&, Été... x-- (a) a-b end.)", "a.b, c..d !? $$$ é$ 9. x9, -y"]
    texts += [" ".join(f"{chr(97 + k % 26)}{chr(945 + k % 24)}w{'.' * (k % 2)}" for k in range(n)) for n in (1, 700, 6000)]
    for group in (texts, texts[::-1]):
        got = [np.frombuffer(x, "<u4").tolist() for x in tokens.texts(group)]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in group]


def test_line_keys_of_a_block_are_those_of_each_line():
    S = substring_dedup
    rng = np.random.default_rng(5)
    lines = [[b"w%d" % k for k in rng.integers(0, 30, n)] for n in (40, 41, 300, 40, 77)]
    hashes, bands = S.line_keys(sum(lines, []), np.array([len(x) for x in lines]))
    for parts, h, keys in zip(lines, hashes.view(np.int64), bands, strict=True):
        w = S.text_word_hashes(b" ".join(parts).decode())
        assert S.line_hash(w) == h
        x = S.windows(w, S.SHINGLE)[None, :] * S.SEEDS[:, None]
        low = (x ^ (x >> np.uint64(29))).min(axis=1).reshape(S.BANDS, S.ROWS)
        key = np.arange(S.BANDS, dtype=np.uint64)
        for k in range(S.ROWS):
            key = S.mix(key + low[:, k])
        assert (key == keys).all()


def test_near_lines_of_a_template_by_brute_force(spark):
    """Lines of one template, most pairs below the threshold: links between
    lines that are both far from the smallest of their band count too."""
    S = substring_dedup
    rng = np.random.default_rng(11)
    base, rows = [f"t{k}" for k in range(60)], []
    for _ in range(700):
        line = list(base)
        for k in rng.integers(0, 60, 3):
            line[k] = f"e{rng.integers(0, 10**6)}"
        rows.append(" ".join(line))
        line[int(rng.integers(0, 60))] = f"e{rng.integers(0, 10**6)}"
        rows.append(" ".join(line))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    classes = S._lines(docs).groupBy("h").agg(F.min("doc_id").alias("doc"), F.max("doc_id").alias("last"),
                                              F.first("bands").alias("bands")).localCheckpoint()
    info = classes.collect()
    at = {r.h: k for k, r in enumerate(info)}
    near = ngram_join.linked([np.unique(S.windows(S.text_word_hashes(rows[r.doc]), S.SHINGLE)) for r in info], S.PERCENT)
    bands = {b: k for k, b in enumerate({b for r in info for b in r.bands})}
    meet = np.zeros((len(info), len(bands)), dtype=np.float32)
    for k, r in enumerate(info):
        meet[k, [bands[b] for b in r.bands]] = 1
    want = ngram_join.labels_of(near & (meet @ meet.T > 0))     # near lines that share a band
    got = np.eye(len(info), dtype=bool)
    for r in S.near_line_pairs(docs, classes).collect():
        got[at[r.u], at[r.v]] = got[at[r.v], at[r.u]] = True
    got = ngram_join.labels_of(got)
    assert len(set(want.tolist())) < 0.7 * len(info) and (got == got[want]).all()
    most = ngram_join.labels_of(near)
    assert (most == most[got]).all()


def test_wrapped_paragraph_with_one_word_changed(spark):
    """A near copy of a wrapped paragraph goes, also with other line breaks."""
    def wrapped(words_, n):
        return "\n".join(" ".join(words_[k:k + n]) for k in range(0, len(words_), n))

    one = [f"p{k}" for k in range(60)]
    two = one[:30] + ["other"] + one[31:]
    lines = [[f"s{j}w{k}" for k in range(18)] for j in range(2)]
    near = [lines[0][:-1] + ["last"], lines[1][:-1] + ["end"]]
    d = spark.createDataFrame([(1, words("a", 70) + "\n\n" + wrapped(one, 15) + "\n\n" + words("b", 70)),
                               (2, words("c", 70) + "\n\n" + wrapped(two, 12) + "\n\n" + words("d", 70)),
                               (3, "\n\n".join(" ".join(x) for x in lines)), (4, "\n\n".join(" ".join(x) for x in near)),
                               (5, "one short line of eight words in all"), (6, "one short line of eight words in all")],
                              "doc_id long, text string")
    got = {(r.doc_id, r.start, r.length, r.kept_doc_id) for r in substring_dedup.duplicate_spans(d).collect()}
    assert got == {(2, 70, 60, 1), (4, 0, 36, 3)}


def test_license_notices_wrapped_over_lines(spark):
    rows = []
    for k, (_, text) in enumerate(license_scan.TEMPLATES):
        w = text.split()
        notice = "\n".join(" * " + " ".join(w[i:i + 5]) for i in range(0, len(w), 5))
        rows += [(k * 100 + n, f"{words('a', n)}\n{notice}\n{words('b', 90)}") for n in (0, 7, 31, 64)]
    rows.append((9999, "\n".join(words(f"n{k}", 9) for k in range(30))))
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) and got[9999].labels == "" and got[9999].score == 0
    for i, _ in rows[:-1]:
        assert license_scan.TEMPLATES[i // 100][0] in got[i].labels.split(",") and got[i].score == 1, i


def test_embeddings_of_failing_shards_are_searched_exactly(spark, monkeypatch):
    """A hot group finds itself by any search; the ordinary pairs do not, and
    the widest beam misses them."""
    for name, value in (("BEAM", 1), ("MAX_BEAM", 1), ("AUDITED", 10**6)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(8)
    centre, pairs = rng.normal(size=64), rng.normal(size=(750, 64))
    x = np.concatenate([centre + 0.03 * rng.normal(size=(600, 64)), pairs, pairs + 0.05 * rng.normal(size=(750, 64))])
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = ((y @ y.T >= 0.9) & ~np.eye(len(y), dtype=bool)).sum(axis=1)
    t = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(t, recall=0.9999).collect()}
    assert [got[k] for k in range(len(y))] == links.tolist()


def test_embeddings_of_other_lengths_repeated_ids_and_copies(spark):
    a, b, c = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.1], [4.0, -3.0, 0.0, 0.0]
    rows = [(1, [1.0] * 8), (2, [1.0] * 8), (3, [-1.0] * 8), (10, a), (11, a), (12, b), (13, c), (20, [2.0]), (21, [3.0]),
            (30, c), (30, [0.0, 1.0]), (31, [0.0, 2.0]), (None, a), (2**53 + 1, [5.0] * 5), (2**53 + 3, [6.0] * 5)]
    rows += [(100 + k, [0.5, 0.25, 0.0]) for k in range(400)] + [(500, [0.5, 0.25, 0.01]), (501, None)]
    t = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, node string, shard int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(t).collect()}
    assert got[1] == got[2][:1] + (1, True) and got[2] == (1, 1, False) and got[3] == (0, 3, True)
    assert got[10] == (2, 10, True) and got[11] == (2, 10, False) and got[12] == (2, 10, False)
    assert got[20] == (1, 20, True) and got[21] == (1, 20, False)
    # 30 is c, as 13 is, and stands beside 31: one component through the id
    assert got[13] == (1, 13, True) and got[30] == (2, 13, False) and got[31] == (1, 13, False)
    assert got[2**53 + 1] == (1, 2**53 + 1, True) and got[2**53 + 3] == (1, 2**53 + 1, False)
    assert got[500] == (400, 100, False) and got[100] == (400, 100, True) and got[499] == (400, 100, False)
    assert got[501] == (0, 501, True) and got[None] == (0, None, None)


def test_license_words_scattered_over_a_line_are_no_notice(spark):
    """One line of thousands of words is covered by windows, as wrapped text
    is; the best containment counts, from a line or a window."""
    notice = dict((label, text) for label, text in license_scan.TEMPLATES)["unlicense"].split()
    far = " ".join(f"{x} " + words(f"w{k}x", 400) for k, x in enumerate(notice))
    near = words("u", 500) + " " + " ".join(notice) + " " + words("v", 500)
    part = " ".join(notice[:9]) + "\nand\n" + " ".join(notice[:9]) + "\n" + " ".join(notice[9:])
    rows = [(1, far), (2, far.replace("w3x", "\nw3x")), (3, near), (4, part)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].score, got[2].labels, got[2].score) == ("", 0, "", 0)
    assert (got[3].labels, got[3].score) == (got[4].labels, got[4].score) == ("unlicense", 1)


def test_discarded_tables_go_and_results_stay(spark, odd):
    """Operators delete the tables they wrote on the way and no longer need."""
    from pathlib import Path
    from leadlens.session import ensure_checkpoint_dir
    folder = Path(ensure_checkpoint_dir(spark)) / "llm"
    kinds = lambda: {p.name for p in folder.iterdir()}
    old = kinds()
    joined, gone = ngram_join.jaccard_components(odd), line_dedup.removed_lines(odd)
    spans = substring_dedup.duplicate_spans(odd)
    left = sorted(x.rsplit("-", 1)[0] for x in kinds() - old)
    assert left == ["line-gone", "ngram-components-nodes", "ngram-counted", "passage-units"]
    assert joined.count() == odd.count() and gone.count() >= 0 and spans.count() > 0
