"""Alignment of two tokenizers' tokens by pointer jumping (operator 11).

A text with a space before it is encoded by a byte-level BPE (A) and by a
piece BPE (B).  Both cover the same bytes, so their tokens form a graph: a
token of A and one of B are linked where they share a byte, and the connected
components are the shortest stretches at whose ends tokens of both end.

Components are found by pointer jumping over all tokens of a batch at once:
every token points to the token farthest to the right that it overlaps (a
token of A to the B token that holds its last byte, a token of B to the A
token that holds its last byte if that one ends later, else to itself), and
the pointers are doubled until they rest on each component's last token.

No token goes on over a single space between two other characters (A's pattern
and B's pieces both begin a token with it), so tokens of both end there.  The
texts of a slice are cut at these places, the distinct parts are encoded and
aligned, all at once, and the documents are put together from the parts.

Corpus-wide counts: a task joins the documents that it reads to blocks of
bounded text and hands on each block's distinct id pairs with the number of
documents that hold them.  These are summed by pair, joined back to the
blocks' pairs and, by block, to the documents' own pairs, so no pair table is
broadcast and a pair that every document holds is one row per block.

Defined cases: null and empty texts, and texts that A or B cannot give back
byte for byte, have no tokens (zeros and an empty digest); long texts are read
whole; rows are independent, so repeated rows count as documents of their
own; a null doc_id stays null; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Recent, byte_letters, vocabulary_path
from .common import documents, materialise

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
SLICE_CHARS = 4_000_000      # text whose distinct parts are encoded together
BLOCK_CHARS = 64_000_000     # text of a block of documents
PARTS_AT_ONCE = 256          # in one text for B
LINKS_AT_ONCE = 1_000_000    # put together in one step

PIECE_SPACE = "\u2581"
# Places where tokens of A and B both end, whatever else the text holds.
CUT = re.compile(r"(?<=\S) (?=\S)")
# A's pre-splitting (fixed by the byte-level BPE's public definition).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ROWS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("held", pa.binary()),
                  ("times", pa.binary()), ("block", pa.int64()), ("pair", pa.int64()), ("docs", pa.int64())])
SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, held binary, "
          "times binary, block long, pair long, docs long")
NO_PAIRS = np.zeros(0, dtype=np.int64)
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def components(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's component, by the number of its last B token, for tokens
    of A and of B that end at these offsets of the same bytes."""
    na, nb = len(a_end), len(b_end)
    over = np.searchsorted(b_end, a_end)                 # the B token with A's last byte
    back = np.searchsorted(a_end, b_end)                 # the A token with B's last byte
    to = np.concatenate([na + over, np.where(a_end[back] == b_end, na + np.arange(nb), back)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:na] - na, to[na:] - na
        to = further


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (of A, of B) of all pairs that share a byte."""
    first = np.searchsorted(b_end, np.concatenate([[0], a_end[:-1]]), side="right")
    n = np.searchsorted(b_end, a_end) - first + 1
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Parts(NamedTuple):
    """Alignments of distinct parts of texts."""

    good: np.ndarray         # whether A and B give the part back
    counts: np.ndarray       # (parts, 4): tokens of A, of B, groups, links
    pairs: np.ndarray        # id pairs of the links, part after part
    texts: pa.LargeStringArray   # the groups, each ended by ";"


class Aligner:
    """Two tokenizers whose tokens are aligned."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = {x: k for k, x in enumerate(byte_letters())}
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        if any(model["vocab"][u + v] != len(letters) + k for k, (u, v) in enumerate(merges)):
            raise ValueError("the ids of A's merges must be in the order of the merges")
        size = len(letters) + len(merges)
        ranks = {bytes(letters[c] for c in x): k for x, k in model["vocab"].items() if k < size}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_a = sorted(ranks, key=ranks.get)
        self.bytes_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(k) else x.replace(PIECE_SPACE, " ").encode()
                        for k, x in enumerate(pieces)]
        self.size_a, self.size_b = [np.array([len(x) for x in y]) for y in (self.bytes_a, self.bytes_b)]
        self.base = len(pieces)                          # an id pair's number: a * base + b
        # ids as text: of A before another of A and before B, of B before another of B and before A
        self.texts = np.array([f"{k}{end}" for ends, n in ((",|", size), (",;", self.base)) for end in ends
                               for k in range(n)], dtype=object)
        self.text_sizes = np.array([len(x) for x in self.texts])
        self.cuts = not any(PIECE_SPACE in x.lstrip(PIECE_SPACE) for x in pieces)

    def _ids(self, parts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens of the parts, end to end, each with a space before it.  Parts
        without white space at the ends are one text to the encoders."""
        edge = [p[0].isspace() or p[-1].isspace() for p in parts]
        inside = [p for p, e in zip(parts, edge, strict=True) if not e]
        a = self.a.encode_ordinary(" " + " ".join(inside)) if inside else []
        b = list(chain.from_iterable(self.b.encode([
            " ".join(inside[k:k + PARTS_AT_ONCE]) for k in range(0, len(inside), PARTS_AT_ONCE)], num_threads=1)))
        for p in [p for p, e in zip(parts, edge, strict=True) if e]:
            a += self.a.encode_ordinary(" " + p)
            b += self.b.encode(p)
        return a, b

    def align(self, parts: list[str]) -> Parts:
        """Alignments of the parts; of those that do not come back, empty ones."""
        parts_of = sorted(range(len(parts)), key=lambda k: parts[k][0].isspace() or parts[k][-1].isspace())
        inside = [k for k in parts_of if PIECE_SPACE not in parts[k]]    # for which B gives a space back
        good = np.zeros(len(parts), dtype=bool)
        counts = np.zeros((len(parts), 4), dtype=np.int64)
        a, b, sizes, todo = [], [], [], [inside]
        taken: list[int] = []
        while todo:
            some = todo.pop()
            if not some:
                continue
            ids_a, ids_b = self._ids([parts[k] for k in some])
            raw = [b" " + parts[k].encode() for k in some]
            joined = b"".join(raw)
            if (b"".join([self.bytes_a[x] for x in ids_a]) == joined
                    and b"".join([self.bytes_b[x] for x in ids_b]) == joined):
                a, b, sizes, taken = a + ids_a, b + ids_b, sizes + [len(x) for x in raw], taken + some
            elif len(some) > 1:
                todo += [some[:len(some) // 2], some[len(some) // 2:]]
        if not taken:
            return Parts(good, counts, np.zeros(0, dtype=np.int64), pa.array([""] * len(parts), pa.large_string()))
        a, b = np.array(a), np.array(b)
        a_end, b_end, ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum(sizes)
        group_a, group_b = components(a_end, b_end)
        link_a, link_b = links(a_end, b_end)
        pairs = a[link_a] * self.base + b[link_b]

        # the tokens of A and B by group, A's first, each with what follows it
        last = lambda g: np.append(g[1:] != g[:-1], True)
        n, m = len(self.size_a), self.base
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        piece = np.concatenate([a + n * last(group_a), b + 2 * n + m * last(group_b)])[order]
        text = "".join(self.texts[piece].tolist()).encode()

        # by part, in the order of the encoding, then as the parts came
        ends_a, ends_b = np.searchsorted(a_end, ends) + 1, np.searchsorted(b_end, ends) + 1
        ends_link = np.searchsorted(link_a, ends_a)
        of = np.array(taken)
        good[of] = True
        counts[of] = np.diff(np.stack([ends_a, ends_b, np.cumsum(last(group_b))[ends_b - 1], ends_link], axis=1), axis=0, prepend=0)
        text_ends = np.concatenate([[0], np.cumsum(self.text_sizes[piece])[ends_a + ends_b - 1]])
        at = np.full(len(parts), len(of))                # the others have the empty text at the end
        at[of] = np.arange(len(of))
        texts = pa.LargeStringArray.from_buffers(
            len(of) + 1, pa.py_buffer(np.append(text_ends, text_ends[-1]).astype(np.int64)), pa.py_buffer(text)).take(pa.array(at))
        starts = np.zeros(len(parts), dtype=np.int64)
        starts[of] = ends_link - counts[of, 3]
        return Parts(good, counts, pairs[spans(starts, counts[:, 3])], texts)

    def documents(self, texts: list[str | None]) -> list[tuple]:
        """Per text: tokens of A, of B, groups, links, digest, and the distinct
        id pairs with the number of their links."""
        full = np.array([bool(t) for t in texts])
        every = pa.array(texts, pa.large_string()).filter(pa.array(full))
        words = pc.split_pattern(every, " ") if self.cuts else pa.array([[t] for t in texts if t], pa.list_(pa.large_string()))
        coded = words.flatten().dictionary_encode()
        odd = np.array([self.cuts and (not w or w[0].isspace() or w[-1].isspace()) for w in coded.dictionary.to_pylist()], dtype=bool)
        # texts with white space around a space are cut at the other spaces only
        bounds = np.diff(words.offsets.to_numpy()) if len(words) else np.zeros(0, dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(bounds)])
        loose = np.diff(np.concatenate([[0], np.cumsum(odd[coded.indices.to_numpy()])])[bounds]) > 0
        out: list[tuple] = [(0, 0, 0, 0, "", NO_PAIRS, NO_PAIRS)] * len(texts)
        if not loose.any():
            for k, got in zip(np.flatnonzero(full).tolist(), self._documents(coded, bounds), strict=True):
                out[k] = got
            return out
        for here, cut in ((~loose, lambda t: t.split(" ")), (loose, CUT.split)):
            at = np.flatnonzero(full)[here].tolist()
            cuts = [cut(texts[k]) for k in at]
            some = pa.array(chain.from_iterable(cuts), pa.large_string()).dictionary_encode()
            of = np.concatenate([[0], np.cumsum([len(x) for x in cuts])]).astype(np.int64)
            for k, got in zip(at, self._documents(some, of), strict=True):
                out[k] = got
        return out

    def _documents(self, words: pa.DictionaryArray, bounds: np.ndarray) -> Iterator[tuple]:
        """``documents`` of texts whose parts are words[bounds[k]:bounds[k + 1]]."""
        parts = self.align(words.dictionary.to_pylist())
        which = words.indices.to_numpy()
        pair_start = np.cumsum(parts.counts[:, 3]) - parts.counts[:, 3]
        for lo, hi in _together(np.add.reduceat(np.append(parts.counts[which, 3], 0), bounds[:-1]) if len(which) else bounds[1:]):
            at = which[bounds[lo]:bounds[hi]]
            inner = bounds[lo:hi + 1] - bounds[lo]
            total = np.concatenate([np.zeros((1, 5), dtype=np.int64), np.cumsum(np.column_stack([parts.counts[at], ~parts.good[at]]), axis=0)])[inner]
            counts = np.diff(total, axis=0).tolist()
            pairs = parts.pairs[spans(pair_start[at], parts.counts[at, 3])]
            text = parts.texts.take(pa.array(at))
            data = memoryview(text.buffers()[2] or b"")
            text_at = np.frombuffer(text.buffers()[1], dtype=np.int64)[inner].tolist() if len(at) else [0] * len(inner)
            link_at = total[:, 3].tolist()
            for k, (n_a, n_b, groups, n_links, bad) in enumerate(counts):
                if bad or not n_a:
                    yield (0, 0, 0, 0, "", NO_PAIRS, NO_PAIRS)
                    continue
                # each group ends in ";", the whole does not
                digest = hashlib.sha256(data[text_at[k]:text_at[k + 1] - 1]).hexdigest()
                yield (n_a, n_b, groups, n_links, digest,
                       *np.unique(pairs[link_at[k]:link_at[k + 1]], return_counts=True))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the runs that start at ``starts``, run after run."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _together(n_links: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents with a bounded number of links, or one document."""
    return _ranges(n_links.tolist(), LINKS_AT_ONCE)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_of(path_a: str, path_b: str) -> Aligner:
    """The aligner, kept for the next task of a reused worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    Recent.keep_only()
    return _ALIGNERS[path_a, path_b]


def _ranges(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that end once their sizes reach the limit."""
    start, size = 0, 0
    for k, n in enumerate(sizes):
        size += n
        if size >= limit:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts in slices of some SLICE_CHARS, over the bounds of batches."""
    ids, texts, chars = [], [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        for lo, hi in _ranges(sizes, SLICE_CHARS // 4):
            ids.append(batch.column("doc_id").cast(pa.int64()).slice(lo, hi - lo))
            texts += batch.column("text").slice(lo, hi - lo).to_pylist()
            chars += sum(sizes[lo:hi])
            if chars >= SLICE_CHARS:
                yield pa.concat_arrays(ids), texts
                ids, texts, chars = [], [], 0
    if texts:
        yield pa.concat_arrays(ids), texts


def _compact(x: np.ndarray) -> bytes:
    """Non-negative integers, the first byte says how wide each is."""
    width = 1 if not len(x) or x.max() < 1 << 8 else 2 if x.max() < 1 << 16 else 4 if x.max() < 1 << 32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=f"<u{x[0]}", offset=1).astype(np.int64)


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(n, f.type) for f in ROWS], schema=ROWS)


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
    return pairs, np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(pairs)).astype(np.int64)


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Rows of documents (pair is null) and of blocks' id pairs (pair is set)."""
    place_a, place_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(place_a, place_b)
        block, chars, found = TaskContext.get().partitionId() << 32, 0, []
        for ids, texts in _slices(batches):
            n_a, n_b, groups, n_links, digest, held, times = zip(*aligner.documents(texts))
            yield _rows(len(texts), doc_id=ids, n_a=n_a, n_b=n_b, n_groups=groups, n_links=n_links, groups_sha256=digest,
                        held=[_compact(np.diff(x, prepend=0)) for x in held], times=[_compact(x) for x in times],
                        block=[block] * len(texts))
            found = [_merged([*found, *((x, np.ones(len(x))) for x in held)])]
            chars += sum(len(t or "") for t in texts)
            if chars >= BLOCK_CHARS:
                yield _rows(len(found[0][0]), block=np.full(len(found[0][0]), block), pair=found[0][0], docs=found[0][1])
                block, chars, found = block + 1, 0, []
        if found:
            yield _rows(len(found[0][0]), block=np.full(len(found[0][0]), block), pair=found[0][0], docs=found[0][1])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    rows = materialise(aligned(docs, path_a, path_b), "aligned")
    import sentencepiece
    base = sentencepiece.SentencePieceProcessor(model_file=path_b or vocabulary_path(VOCABULARY_B)).get_piece_size()
    of_blocks = rows.where("pair is not null")
    counts = materialise(of_blocks.groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-counts")
    counts = counts.withColumn("a", F.expr(f"pair div {base}"))
    best = counts.groupBy("a").agg(F.max("docs").alias("most"))
    counts = counts.join(best, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    known = of_blocks.select(F.col("block").alias("of"), "pair").join(counts, "pair")

    def run(of_docs: pa.Table, of_pairs: pa.Table) -> pa.Table:
        pair = of_pairs.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, docs = pair[order], of_pairs.column("docs").to_numpy()[order]
        best = of_pairs.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, count_sum = [], []
        for held, times in zip(of_docs.column("held").to_pylist(), of_docs.column("times").to_pylist(), strict=True):
            at, n = np.searchsorted(pair, np.cumsum(_wide(held))), _wide(times)
            n_best.append(int(n[best[at]].sum()) if len(n) else 0)
            count_sum.append(int((n * docs[at]).sum()) if len(n) else 0)
        return of_docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column(
            "n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column(
            "groups_sha256", of_docs.column("groups_sha256"))

    of_docs = rows.where("pair is null").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "held", "times", "block")
    return of_docs.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, RESULT)


def op11_token_alignment(spark, sf_dir) -> DataFrame:
    return alignment(documents(spark, sf_dir))
