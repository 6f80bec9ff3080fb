"""BPE encoding and decoding with a tokenization automaton (operator 5).

The merge list is compiled into a deterministic automaton whose states are
the tokens (the last token read) and whose arcs are labelled with tokens.
It starts from all arcs; the gadget of each merge (u, v), in rank order,
takes away the arcs x -> y across which that merge would act: x ends in u
and y begins with v at the moment of the merge, that is, u is on x's right
spine and v on y's left spine and neither has been merged further by then.
What is left accepts exactly the token sequences that BPE produces, so a
word has one accepting path.  The dense table would have 49k x 49k arcs, so
the gadgets are stored (spines and merge ranks) and an arc is decided by
them when first met, then kept in the transition table.

Encoding reads a pre-split word left to right and records, per prefix, the
state the automaton reaches: a table of the tokens' spellings from their last
letter gives the tokens that end there, and the one whose arc comes from the
state before it is taken.  States of a prefix shared with the word before are
kept, so new words are read in alphabetical order.  Decoding emits the labels
of the arcs.

Runs inside tasks, one pass, no shuffle.  Memory: the table of words and
arcs seen, both cleared at a fixed size.

Defined cases: null and empty texts have no tokens; very long words take
linear time; rows are independent, so repeated rows and extra columns do
not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import documents, integers_again, integers_as_text

VOCABULARY = "word_bpe_49k.json"
MAX_WORDS = 250_000          # words in each of the two halves of a task's cache
MAX_ARCS = 2_000_000         # decided arcs per task process
GROUP_LETTERS = 8_000_000    # texts whose distinct parts are looked up together

# Unicode White_Space (fixed values).
WHITE = "\t-\r \x85\xa0  -     　"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
GAPS = re.compile(f"[{WHITE}]+")
#: what str.split() takes for white space and Unicode does not
ODD = re.compile("[\x1c-\x1f]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def chunks(text: str) -> list[str]:
    """Parts of a text between white space; no token crosses them."""
    if ODD.search(text):
        return [x for x in GAPS.split(text) if x]
    return text.split()


#: white space beyond ASCII, or taken for it by Python
OTHER_WHITE = re.compile(f"[\x1c-\x1f{WHITE[4:]}]")


def coded(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts between white space of some texts, the number of the
    part at each place, and each text's first place, with the end of the last."""
    column = pa.array([" ".join(chunks(t)) if t and not t.isascii() and OTHER_WHITE.search(t) or t and ODD.search(t) else t or ""
                       for t in texts], pa.large_string())
    parts = pc.ascii_split_whitespace(column)
    flat = parts.flatten()
    there = pc.not_equal(flat, "")          # before the first and after the last white space
    starts = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])[parts.offsets.to_numpy()]
    flat = flat.filter(there).dictionary_encode()
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(), starts


def joined(found: list[bytes], at: np.ndarray, starts: np.ndarray) -> Iterator[bytes]:
    """Per text the ids of its parts, given those of each distinct part."""
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    n = sizes[at]
    begins = np.concatenate([[0], np.cumsum(n)])
    places = np.repeat((np.cumsum(sizes) - sizes)[at] - begins[:-1], n) + np.arange(begins[-1])
    ids = np.frombuffer(b"".join(found), "<u4")[places]
    ends = begins[starts].tolist()
    for begin, end in zip(ends, ends[1:]):
        yield ids[begin:end].tobytes()


def groups(texts, letters: int = GROUP_LETTERS) -> Iterator[list[str | None]]:
    """The texts in groups of some letters, or one longer text."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size > letters:
            yield group
            group, size = [], 0
    if group:
        yield group


def id_bytes(ids: list[int]) -> bytes:
    """ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable in Latin-1,
    else the next free code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(free))
        free += b not in plain
    return out


class Recent(dict):
    """Cache of at most two times ``limit`` keys: when the newer half is
    full it becomes the older one, and keys used again move to the newer.
    Subclasses compute a value in ``make``; keys over 64 letters are not kept."""

    limit = MAX_WORDS
    all: list["Recent"] = []

    def __init__(self):
        super().__init__()
        self.older: dict = {}
        Recent.all.append(self)

    @staticmethod
    def keep_only(*kept: "Recent") -> None:
        """Empty the other caches of this worker: a reused worker serves
        several operators, and only the present one's cache counts."""
        for x in Recent.all:
            if not any(x is k for k in kept):
                x.clear()
                x.older = {}

    def __missing__(self, key: str):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
            if len(key) > 64:
                return got
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = got
        return got


class Automaton:
    """Token automaton of a merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        n = 1 + max([*self.ids.values(), *self.special.values()])
        self.labels = [""] * n
        for x, i in [*self.ids.items(), *self.special.items()]:
            self.labels[i] = x
        self.rank: dict[tuple[int, int], int] = {}
        born = [-1] * n
        parts: list[tuple[int, int] | None] = [None] * n
        for r, (a, b) in enumerate(model["merges"]):
            u, v, w = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[u, v] = r
            if parts[w] is None:
                parts[w], born[w] = (u, v), r
        self.right = [self._spine(t, parts, born, 1) for t in range(n)]
        self.left = [self._spine(t, parts, born, 0) for t in range(n)]
        self.arcs: dict[int, bool] = {}           # by x * number of tokens + y
        self.made: dict[int, bool] = {}
        # spellings of the tokens BPE can make, inside a word and at its end
        use = [(x, t) for x, t in self.ids.items() if self._reaches(t)]
        self.ends = {x.removesuffix(self.end): t for x, t in use if x.endswith(self.end)}
        # letter -> [next letters, token inside a word, token at its end], from the last letter on
        self.spellings: dict[str, list] = {}
        for x, t in use:
            at_end = bool(self.end) and x.endswith(self.end)
            nexts = self.spellings
            for letter in reversed(x.removesuffix(self.end) if at_end else x):
                node = nexts.setdefault(letter, [{}, -1, -1])
                nexts = node[0]
            node[2 if at_end or not self.end else 1] = t
            if not self.end:
                node[1] = t
        self.read, self.states, self.starts = "", [-1], [0]     # the last word's prefixes
        self.letters = byte_letters()
        self.words = WordPaths(self)
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    @staticmethod
    def _spine(t: int, parts, born, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of t, with the rank at which each is merged away."""
        out, until = [(t, float("inf"))], float("inf")
        while parts[t] is not None:
            until = born[t]
            t = parts[t][side]
            out.append((t, until))
        return out

    def arc(self, x: int, y: int) -> bool:
        """Whether y may follow x.  On equal ranks the left place merges
        first, hence < for x and <= for y."""
        key = x * len(self.labels) + y
        got = self.arcs.get(key)
        if got is None:
            rank, got = self.rank, True
            for u, gone_u in self.right[x]:
                for v, gone_v in self.left[y]:
                    r = rank.get((u, v))
                    if r is not None and r < gone_u and r <= gone_v:
                        got = False
                        break
                if not got:
                    break
            if len(self.arcs) >= MAX_ARCS:
                self.arcs.clear()
            self.arcs[key] = got
        return got

    def _last(self, word: str, i: int, side: int) -> tuple[int, int]:
        """The last token of the first ``i`` letters and where it starts; side
        1: inside the word, 2: at its end."""
        nexts, found, j = self.spellings, [], i
        while j:
            node = nexts.get(word[j - 1])
            if node is None:
                break
            j -= 1
            nexts = node[0]
            if node[side] >= 0:
                found.append((node[side], j))
        arcs, states, n = self.arcs, self.states, len(self.labels)
        for t, j in reversed(found):
            if not j:
                return t, 0
            ok = arcs.get(states[j] * n + t)
            if ok or ok is None and self.arc(states[j], t):
                return t, j
        return -1, 0

    def word(self, word: str) -> list[int]:
        """Token ids of one word given as byte letters."""
        whole = self.ends.get(word)
        if whole is not None:
            return [whole]
        n, same = len(word), 0
        if not n:
            return []
        for a, b in zip(self.read, word):
            if a != b:
                break
            same += 1
        states, starts = self.states, self.starts
        same = min(same, n - 1)
        del states[same + 1:], starts[same + 1:]
        self.read = word[:-1]
        for i in range(same + 1, n):
            t, j = self._last(word, i, 1)
            states.append(t)
            starts.append(j)
        t, i = self._last(word, n, 2)
        out = [t]
        while i > 0:
            out.append(states[i])
            i = starts[i]
        return out[::-1]

    def _reaches(self, t: int) -> bool:
        """Whether t is made by BPE from its own letters: its halves, and
        theirs, have no arc that an earlier merge would cross."""
        got = self.made.get(t)
        if got is None:
            spine = self.right[t]
            got = True
            if len(spine) > 1:
                v, born = spine[1]
                u = self.left[t][1][0]
                got = self._reaches(u) and self._reaches(v) and self._first_merge(u, v) == born
            self.made[t] = got
        return got

    def _first_merge(self, x: int, y: int) -> float:
        ranks = [r for u, gone_u in self.right[x] for v, gone_v in self.left[y]
                 if (r := self.rank.get((u, v))) is not None and r < gone_u and r <= gone_v]
        return min(ranks, default=-1)

    def letters_of(self, part: str) -> str:
        return part if part.isascii() and part.isprintable() else "".join([self.letters[b] for b in part.encode()])

    def chunk(self, chunk: str) -> list[int]:
        """Token ids of a part without white space."""
        if chunk.isalpha():
            low = unicodedata.normalize("NFC", chunk).lower()
            if low.isalpha() and "Σ" not in chunk:
                return self.words[self.letters_of(low)]
        out: list[int] = []
        for part in self.split_special.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self.special[part])
                continue
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            if part[:-1].isalpha() and part[-1] in ".,;:!?":
                out += self.words[self.letters_of(part[:-1])]
                out += self.words[part[-1]]
                continue
            for x in PIECES.findall(part):
                out += self.words[self.letters_of(x)]
        return out

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined as the library joins them."""
        return " ".join([self.labels[i] for i in ids])


class WordPaths(Recent):
    """word -> token ids."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def make(self, word: str) -> list[int]:
        return self.automaton.word(word)


class Words(Recent):
    """chunk -> (id bytes, decoded labels), filled by the automaton."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def make(self, chunk: str) -> tuple[bytes, str]:
        ids = self.automaton.chunk(chunk)
        return id_bytes(ids), self.automaton.decode(ids)


_WORDS: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """The automaton and its caches, kept for the next task of a reused worker."""
    if path not in _WORDS:
        _WORDS[path] = Words(Automaton(path))
    Recent.keep_only(_WORDS[path], _WORDS[path].automaton.words)
    return _WORDS[path]


def encode_texts(words: Words, texts) -> Iterator[tuple[bytes, str]]:
    """(ids as little-endian unsigned 32-bit integers, decoded text) per text."""
    for group in groups(texts):
        parts, at, starts = coded(group)
        for part in sorted(set(parts).difference(words)):
            words[part]
        found = list(map(words.__getitem__, parts))
        labels, places, ends = [b for _, b in found], at.tolist(), starts.tolist()
        every = all(labels)
        for ids, begin, end in zip(joined([a for a, _ in found], at, starts), ends, ends[1:]):
            said = map(labels.__getitem__, places[begin:end])
            yield ids, " ".join(said if every else filter(None, said))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, ids (array<long>), decoded."""
    place = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = words_of(place)
        for pdf in batches:
            got = list(encode_texts(words, pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [np.frombuffer(a, "<u4").astype("i8") for a, _ in got],
                                "decoded": [b for _, b in got]})

    docs = docs.select("doc_id", "text")
    return integers_again(integers_as_text(docs).mapInPandas(run, "doc_id string, ids array<long>, decoded string"), docs)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    place = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = words_of(place)
        for pdf in batches:
            n, a, b = [], [], []
            for ids, decoded in encode_texts(words, pdf["text"]):
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    docs = docs.select("doc_id", "text")
    return integers_again(integers_as_text(docs).mapInPandas(
        run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"), docs)


def op5_bpe_automaton(spark, sf_dir) -> DataFrame:
    return digests(documents(spark, sf_dir))
