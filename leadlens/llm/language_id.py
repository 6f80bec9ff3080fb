"""Language identification with segmentation-marginalised unigrams
(operator 10).

A language is a unigram distribution over the pieces of a fixed public
vocabulary.  The probability of a word is the sum over all its segmentations
into pieces of the product of their probabilities, computed left to right
by the forward algorithm; a text's score is the product over its words and
the language's prior.

Learning counts each (language, word) over all training rows in Spark, and
each round of expectation maximisation computes the expected piece counts
of every counted word by the forward-backward algorithm and sums them per
(language, piece).  That sum is the model: at most vocabulary x languages
numbers, whatever the corpus, so it is sent to the tasks as a whole.

Defined cases: null texts and texts without letters are ``und`` with score
0; rows with null ``lang`` or null id are not learned from; without any
training row everything is ``und``; words of any length are scored whole
(rescaled, so nothing underflows); ties go to the first language in order;
repeated rows count as often as they occur; an empty table gives an empty
table.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Recent, byte_letters, vocabulary_path
from .common import documents, integers_again, integers_as_text, materialise

ROUNDS = 1
SMOOTHING = 0.5            # added to each expected piece count
MAX_WORDS = 400_000        # words counted in a task before they are handed on
LETTERS = regex.compile(r"\p{L}+")
FOLD, HELD_OUT = 4, 2      # contract: crc32(doc_id as text) mod 4 is 2
LOW = 1e-150
SHORT = 40                 # byte letters of words that are worked in blocks
GROUP = 300_000            # words of the texts that are scored together
BLOCK = 8_192              # words in a block
BASE = 0x9E3779B97F4A7C15  # of the hashes of spellings, odd


def text_words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


class Pieces:
    """The fixed vocabulary over byte letters: pieces inside a word and at its end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.ends = {x.removesuffix(end): t for x, t in vocab.items() if x.endswith(end)}
        self.mids = {x: t for x, t in vocab.items() if not end or not x.endswith(end)}
        self.longest = max(map(len, [*self.ends, *self.mids]))
        self.letters = byte_letters()
        self._tables = None

    def spell(self, word: str) -> str:
        return word if word.isascii() else "".join([self.letters[b] for b in word.encode("utf-8", "replace")])

    def tables(self):
        """Sorted hashes and ids of the pieces by length, inside and at the end of words."""
        if self._tables is None:
            out = []
            for names in (self.mids, self.ends):
                keys, ids = [], []
                for l in range(self.longest + 1):
                    pair = sorted((sum((ord(c) + 1) * pow(BASE, k, 2**64) for k, c in enumerate(reversed(x))) % 2**64, t)
                                  for x, t in names.items() if len(x) == l)
                    keys.append(np.array([k for k, _ in pair], dtype=np.uint64))
                    ids.append(np.array([t for _, t in pair], dtype=np.int64))
                    if len(np.unique(keys[-1])) < len(pair):
                        raise ValueError("two pieces share a hash")
                out += [keys, ids]
            self._tables = tuple(out)
        return self._tables

    def arcs(self, word: str) -> list[list[tuple[int, int]]]:
        """For each end i in 0..n the (start, piece) that end there."""
        x = self.spell(word)
        n, out, longest = len(x), [[]], self.longest
        for i in range(1, n + 1):
            names = self.ends if i == n else self.mids
            out.append([(j, t) for j in range(i - longest if i > longest else 0, i)
                        if (t := names.get(x[j:i])) is not None])
        return out


def log_probability(arcs, table, langs: int) -> list[float]:
    """Log probability of a word in each language: the forward sums of all
    languages side by side, rescaled together when they become small."""
    alpha, scale = [[1.0] * langs], [[0.0] * langs]
    each = range(langs)
    for ends in arcs[1:]:
        s, a = scale[-1], [0.0] * langs
        for j, t in ends:
            row, w = table[t], alpha[j]
            if scale[j] is s:
                for k in each:
                    a[k] += w[k] * row[k]
            else:
                for k in each:
                    a[k] += w[k] * row[k] * math.exp(scale[j][k] - s[k])
        if min(a) < LOW:
            s = [x + math.log(y) for x, y in zip(s, a, strict=True)]
            a = [1.0] * langs
        alpha.append(a)
        scale.append(s)
    return [math.log(x) + y for x, y in zip(alpha[-1], scale[-1], strict=True)]


def _sweep(steps, n: int, p) -> tuple[list[float], list[float]]:
    """Sums over paths from position 0; steps[i] are the (from, piece) into i."""
    alpha, scale = [1.0], [0.0]
    for i in range(1, n + 1):
        s = scale[-1]
        a = 0.0
        for j, t in steps[i]:
            a += alpha[j] * p[t] if scale[j] == s else alpha[j] * p[t] * math.exp(scale[j] - s)
        if a < LOW:
            s += math.log(a)
            a = 1.0
        alpha.append(a)
        scale.append(s)
    return alpha, scale


def expected_counts(arcs, p) -> dict[int, float]:
    """Expected number of each piece over all segmentations (forward-backward)."""
    n = len(arcs) - 1
    turned: list[list[tuple[int, int]]] = [[] for _ in arcs]
    for i in range(1, n + 1):
        for j, t in arcs[i]:
            turned[n - j].append((n - i, t))
    alpha, sa = _sweep(arcs, n, p)
    beta, sb = _sweep(turned, n, p)
    total, scaled, out = alpha[n], sa[n], {}
    for i in range(1, n + 1):
        b, s = beta[n - i] / total, sb[n - i] - scaled
        for j, t in arcs[i]:
            x = alpha[j] * p[t] * b
            if s or sa[j]:
                x *= math.exp(s + sa[j])
            out[t] = out.get(t, 0.0) + x
    return out


class Lattice:
    """The segmentations of many words at once.

    The words (at most ``SHORT`` byte letters each) are sorted by length,
    longest first, and written into rows of codes; ``hits[i][l]`` are the
    (rows, pieces) of length l that end at place i."""

    def __init__(self, pieces: Pieces, spelled: list[str]):
        self.order = sorted(range(len(spelled)), key=lambda k: -len(spelled[k]))
        rows = [spelled[k] for k in self.order]
        self.lengths = np.array([len(x) for x in rows], dtype=np.int64)
        self.n = int(self.lengths[0]) if rows else 0
        codes = np.zeros((len(rows), self.n), dtype=np.uint64)
        flat = np.array([ord(c) for c in "".join(rows)], dtype=np.uint64) + np.uint64(1)
        codes[np.arange(self.n)[None, :] < self.lengths[:, None]] = flat
        self.hits = [[] for _ in range(self.n + 1)]
        keys, ids, keys_end, ids_end = pieces.tables()
        for i in range(1, self.n + 1):
            many = int(np.searchsorted(-self.lengths, -i, side="right"))   # rows with a letter i
            last = int(np.searchsorted(-self.lengths, -i, side="left"))    # those from here on end at i
            h = np.zeros(many, dtype=np.uint64)
            power = np.uint64(1)
            for l in range(1, min(i, pieces.longest) + 1):
                h = h + codes[:many, i - l] * power          # spelled backwards, wraps
                power = np.uint64((int(power) * BASE) % 2**64)
                for a, b, k, t in ((0, last, keys[l], ids[l]), (last, many, keys_end[l], ids_end[l])):
                    if a < b and len(k):
                        at = np.searchsorted(k, h[a:b])
                        at[at == len(k)] = 0
                        found = np.flatnonzero(k[at] == h[a:b])
                        if len(found):
                            self.hits[i].append((l, a + found, t[at[found]]))

    def forward(self, table: np.ndarray) -> np.ndarray:
        """alpha[place, row, language] for table[piece, language]."""
        alpha = np.zeros((self.n + 1, len(self.lengths), table.shape[1]))
        alpha[0] = 1.0
        for i in range(1, self.n + 1):
            for l, rows, t in self.hits[i]:
                alpha[i, rows] += alpha[i - l, rows] * table[t]
        return alpha

    def log_probabilities(self, table: np.ndarray) -> list[list[float]]:
        """Per word, in the order given, its log probability by language."""
        alpha = self.forward(table)
        got = np.log(alpha[self.lengths, np.arange(len(self.lengths))]).tolist()
        out: list = [None] * len(got)
        for k, x in zip(self.order, got, strict=True):
            out[k] = x
        return out

    def expected(self, p: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected counts [piece, language] with words weighted by
        ``weights[word, language]``."""
        alpha = self.forward(p[:, None])[:, :, 0]
        m = len(self.lengths)
        beta = np.zeros((self.n + 1, m))
        beta[self.lengths, np.arange(m)] = 1.0 / alpha[self.lengths, np.arange(m)]
        w = weights[self.order]
        out = np.zeros((len(p), w.shape[1]))
        for i in range(self.n, 0, -1):
            for l, rows, t in self.hits[i]:
                x = p[t] * beta[i, rows]
                beta[i - l, rows] += x
                x = x * alpha[i - l, rows]
                for k in range(w.shape[1]):
                    out[:, k] += np.bincount(t, x * w[rows, k], minlength=len(p))
        return out


def word_counts(training: DataFrame, langs: list[str]) -> DataFrame:
    """(word, n): occurrences by language, over all training rows; counted
    per task first."""
    at = {x: k for k, x in enumerate(langs)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out():
            return pd.DataFrame([(k, w, n) for k, c in enumerate(counts) for w, n in c.items()],
                                columns=["k", "word", "n"])

        counts = [Counter() for _ in langs]
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                counts[at[lang]].update(text_words(text))
                if sum(map(len, counts)) > MAX_WORDS:
                    yield out()
                    counts = [Counter() for _ in langs]
        yield out()

    part = training.select("lang", "text").mapInPandas(run, "k int, word string, n long")
    return part.groupBy("word").agg(F.array(*[
        F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)) for k in range(len(langs))]).alias("n"))


def _sum_pieces(counts: DataFrame, path: str, langs: list[str], model) -> list[list[float]]:
    """One round: table[piece][language] of smoothed, normalised expected
    counts under ``model`` (by language; None: all pieces alike)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(path)
        flat = np.full(pieces.size, 1.0 / pieces.size)
        models = None if model is None else [np.array(x) for x in model]
        sums = np.zeros((pieces.size, len(langs)))
        for pdf in batches:
            spelled = [pieces.spell(w) for w in pdf["word"]]
            n = np.array(pdf["n"].tolist(), dtype=float).reshape(len(pdf), len(langs))
            short = [k for k, x in enumerate(spelled) if len(x) <= SHORT]
            for at in range(0, len(short), BLOCK):
                ks = short[at:at + BLOCK]
                lattice = Lattice(pieces, [spelled[k] for k in ks])
                if models is None:
                    sums += lattice.expected(flat, n[ks])
                else:
                    for k, p in enumerate(models):
                        sums[:, k] += lattice.expected(p, n[ks][:, k:k + 1])[:, 0]
            for k, word in enumerate(pdf["word"]):
                if len(spelled[k]) > SHORT:
                    arcs = pieces.arcs(word)
                    for lang in np.flatnonzero(n[k]):
                        for t, x in expected_counts(arcs, flat if models is None else models[lang]).items():
                            sums[t, lang] += n[k, lang] * x
        t, k = np.nonzero(sums)
        yield pd.DataFrame({"k": k, "t": t, "x": sums[t, k]})

    rows = (counts.mapInPandas(run, "k int, t int, x double")
            .groupBy("k", "t").agg(F.sum("x").alias("x")).collect())   # at most vocabulary x languages
    size = Pieces(path).size
    table = [[SMOOTHING] * len(langs) for _ in range(size)]
    for r in rows:
        table[r["t"]][r["k"]] += r["x"]
    totals = [sum(row[k] for row in table) for k in range(len(langs))]
    return [[x / y for x, y in zip(row, totals, strict=True)] for row in table]


def learn(training: DataFrame, path: str | None = None, rounds: int = ROUNDS):
    """(languages, priors, rows): rows[piece] is the piece's probability in
    each language."""
    place = path or vocabulary_path()
    known = training.where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], [], []
    counts = materialise(word_counts(known, langs), "lang-words")
    table = None
    for _ in range(rounds):
        model = None if table is None else [[row[k] for row in table] for k in range(len(langs))]
        table = _sum_pieces(counts, place, langs, model)
    rows = sum(sizes.values())
    return langs, [math.log(sizes[x] / rows) for x in langs], table


class WordScores(Recent):
    """word -> log probability per language, summed over segmentations; the
    new words of a group of texts are scored in blocks."""

    def __init__(self, pieces: Pieces, table):
        super().__init__()
        self.pieces, self.table, self.np_table = pieces, table, np.array(table)
        self.new: dict[str, list[float]] = {}

    def make(self, word: str) -> list[float]:
        got = self.new.get(word)
        return log_probability(self.pieces.arcs(word), self.table, len(self.table[0])) if got is None else got

    def prepare(self, group: list[list[str]]) -> None:
        older = self.older
        words = [w for w in set().union(*group).difference(self) if w not in older]
        spelled = [self.pieces.spell(w) for w in words]
        short = [k for k, x in enumerate(spelled) if len(x) <= SHORT]
        self.new = {}
        for at in range(0, len(short), BLOCK):
            ks = short[at:at + BLOCK]
            got = Lattice(self.pieces, [spelled[k] for k in ks]).log_probabilities(self.np_table)
            self.new.update((words[k], x) for k, x in zip(ks, got, strict=True))


def predict(docs: DataFrame, model, path: str | None = None) -> DataFrame:
    """doc_id, lang_pred, score (posterior of the predicted language), and
    every column named in ``docs`` but text."""
    langs, priors, table = model
    place = path or vocabulary_path()
    shared = docs.sparkSession.sparkContext.broadcast(table)
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = WordScores(Pieces(place), shared.value) if langs else None

        def judge(group):
            if scores is not None:
                scores.prepare(group)
            for found in group:
                if not found or scores is None:
                    yield "und", 0.0
                    continue
                total = list(priors)
                for row in map(scores.__getitem__, found):
                    total = [a + b for a, b in zip(total, row)]  # noqa: B905
                best = max(range(len(langs)), key=lambda k: (total[k], -k))
                yield langs[best], 1.0 / sum(math.exp(max(-700.0, x - total[best])) for x in total)

        for pdf in batches:
            got, group, n = [], [], 0
            for text in pdf["text"]:
                group.append(text_words(text))
                n += len(group[-1])
                if n > GROUP:
                    got += judge(group)
                    group, n = [], 0
            got += judge(group)
            yield pdf[keep].assign(lang_pred=[x for x, _ in got], score=[x for _, x in got])
        if scores is not None:
            Recent.all[:] = [x for x in Recent.all if x is not scores]

    given = integers_as_text(docs)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "text")
    return integers_again(given.mapInPandas(run, f"{fields}, lang_pred string, score double"), docs.drop("lang_pred", "score"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLD == HELD_OUT, F.lit(False))


def op10_language_id(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
