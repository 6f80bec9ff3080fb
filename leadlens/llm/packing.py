"""Sum-of-squares online packing (operator 6).

Each task packs the documents of its partition, in order, into windows of
``SIZE`` tokens.  Whole windows are cut off a document first; its rest goes
to the fill level that minimises the sum over levels of the squared number
of partially filled windows at that level.  The numbers are kept in an
array by level, so a placement looks at at most ``SIZE`` numbers whatever
the number of documents.

At the end of a task (and whenever ``OPEN`` windows are open, so that memory
is bounded) the open windows are joined end to end and cut at ``SIZE``; the
last remainder of a task is cut into powers of two, which need no padding.

No shuffle: a partition of any source or size is a task of its own, and a
lost task is rerun from its input files with the same result.

Defined cases: null and empty texts are one end token; repeated rows are
packed as often as they occur; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Recent, byte_letters, coded, groups, id_bytes, joined, vocabulary_path
from .common import documents

SIZE = 4096
END = 2
OPEN = 512
GROUP = 1_000_000            # letters of texts whose words are looked up together
JOINED = 5000                # new words encoded as one text
STOPS = ".,;:!?$%&*#+-/=()"   # a word and a run of these are two pieces
TAIL = re.compile(r"[^a-z ]+")
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class TextIds(Recent):
    """Ids of texts as bytes, by the tokenizers library; words are cached, and
    the new ones of a group of texts are encoded in one call."""

    limit = 200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # the same model for lower-case ASCII words, which need no normalising
        self.ascii = Tokenizer(self.tokenizer.model)
        self.ascii.pre_tokenizer = WhitespaceSplit()
        # tokens that end a piece; without one for each byte, words are encoded one by one
        vocab, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(1 + max(vocab.values()), dtype=bool)
        if suffix and all(x + suffix in vocab for x in byte_letters()):
            self.last[[i for x, i in vocab.items() if x.endswith(suffix)]] = True

    def texts(self, texts) -> Iterator[bytes]:
        for group in groups(texts, GROUP):
            words, at, starts = coded(group)
            yield from joined(self.known(words), at, starts)

    def known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; those not met before are encoded together."""
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        out = list(map(self.get, words))
        missing = [k for k, e in enumerate(out) if e is None]
        found = list(map(self.older.get, map(words.__getitem__, missing)))
        new = [words[k] for k, e in zip(missing, found, strict=True) if e is None]
        encoded = iter(self.several(new))
        for k, e in zip(missing, found, strict=True):
            if e is None:
                e = next(encoded)
            out[k] = e
            w = words[k]
            if len(w) <= 64:
                self[w] = e
        return out

    def ids_joined(self, text: str, ascii: bool) -> list[int]:
        """Ids of words (with or without stops) between single spaces."""
        tokenizer = self.tokenizer
        if ascii:
            tokenizer, text = self.ascii, text.lower()
            text = TAIL.sub(r" \g<0>", text)
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def several(self, new: list[str]) -> list[bytes]:
        """Ids of new parts.  Words, with or without stops, are encoded as one
        text and cut after the tokens that end a piece: none has fewer pieces
        than counted here, so an equal total means that every one is cut
        right; where it differs, and for other parts, each is encoded alone."""
        out: list[bytes] = [b""] * len(new)
        plain: tuple[list[int], list[int]] = ([], [])    # others, ASCII
        alone, by_word = [], self.last.any()
        for k, c in enumerate(new):
            if by_word and (c.isalpha() or c.rstrip(STOPS).isalpha()):
                plain[c.isascii()].append(k)
            else:
                alone.append(k)
        for ascii in (True, False):
            for at in range(0, len(plain[ascii]), JOINED):
                part = plain[ascii][at:at + JOINED]
                some = [new[k] for k in part]
                ids = np.array(self.ids_joined(" ".join(some), ascii), dtype="<u4")
                ends = np.flatnonzero(self.last[ids]) + 1
                count = np.cumsum([1 if c.isalpha() else 2 for c in some])
                if len(ends) != count[-1]:
                    alone += part
                    continue
                raw, begin = ids.tobytes(), 0
                for k, end in zip(part, (4 * ends[count - 1]).tolist(), strict=True):
                    out[k] = raw[begin:end]
                    begin = end
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([new[k] for k in alone], add_special_tokens=False), strict=True):
            out[k] = id_bytes(e.ids)
        return out


_IDS: dict[str, TextIds] = {}


def ids_of(path: str) -> TextIds:
    """The tokenizer and its cache, kept for the next task of a reused worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"     # the tasks are the parallelism
    if path not in _IDS:
        _IDS[path] = TextIds(path)
    Recent.keep_only(_IDS[path])
    return _IDS[path]


class Packer:
    """Windows of one task.  A piece is (doc_id, start, id bytes, doc_tokens)."""

    def __init__(self, first_sequence: int, size: int = SIZE, open_limit: int = OPEN):
        self.size, self.limit, self.next = size, open_limit, first_sequence
        self.levels = np.zeros(size + 1, dtype=np.int64)
        self.windows: dict[int, list[list]] = {}
        self.open = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, at))
            at += n
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        start = 0
        while total - start >= self.size:
            self.close([(doc, start, ids[4 * start:4 * (start + self.size)], total)])
            start += self.size
        if start < total:
            self.place((doc, start, ids[4 * start:], total))
            if self.open > self.limit:
                self.drain()

    def place(self, piece) -> None:
        r, size, levels = len(piece[2]) // 4, self.size, self.levels
        had = np.flatnonzero(levels[1:size - r + 1]) + 1
        # change of the sum of squares: new window, then each level that fits
        best, level = 2 * levels[r] + 1, 0
        if len(had):
            to = levels[had + r]
            to[had + r == size] = 0
            change = 2 * (to - levels[had]) + 2 - (had + r == size)
            k = len(had) - 1 - int(np.argmin(change[::-1]))   # fullest level on ties
            if change[k] <= best:
                level = int(had[k])
        pieces = []
        if level:
            pieces = self.windows[level].pop()
            levels[level] -= 1
            self.open -= 1
        pieces.append(piece)
        if level + r == size:
            self.close(pieces)
        else:
            self.windows.setdefault(level + r, []).append(pieces)
            levels[level + r] += 1
            self.open += 1

    def drain(self, last: bool = False) -> None:
        """Join the open windows and cut whole ones; the rest stays open or,
        at the end, becomes sequences of powers of two."""
        rest = [p for level in sorted(self.windows, reverse=True) for ps in self.windows[level] for p in ps]
        left = sum(len(p[2]) for p in rest) // 4
        self.windows, self.open = {}, 0
        self.levels[:] = 0
        rest.reverse()
        while left >= self.size or (last and left):
            want = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= want
            pieces = []
            while want:
                doc, start, ids, total = rest.pop()
                n = len(ids) // 4
                if n > want:
                    rest.append((doc, start + want, ids[4 * want:], total))
                    ids, n = ids[:4 * want], want
                pieces.append((doc, start, ids, total))
                want -= n
            self.close(pieces)
        if left:
            self.windows[left] = [rest[::-1]]
            self.levels[left] = 1
            self.open = 1

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))], names=names)


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """One row per piece (see SCHEMA)."""
    place = path or vocabulary_path()
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sequence numbers: the task's partition above 2^33 numbers of its own
        packer = Packer(TaskContext.get().partitionId() << 33, size)
        tokens = ids_of(place)
        for batch in batches:
            # the texts stay in Arrow; those of a group at a time become strings
            docs, texts = ((x.as_py() for x in batch.column(c)) for c in ("doc_id", "text"))
            for doc, ids in zip(docs, tokens.texts(texts), strict=True):
                packer.add(doc, ids + end)
            yield packer.take()
        packer.drain(last=True)
        yield packer.take()
        tokens.older = {}        # the worker may wait beside the next stage

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def op6_sum_of_squares_packing(spark, sf_dir) -> DataFrame:
    return pack(documents(spark, sf_dir))
