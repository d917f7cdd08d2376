"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus is counted once; its most frequent words and their id sequences are
compiled into a minimal acyclic automaton (words with a common ending share its
states).  Each state knows how many words lie below it, so walking a word also
yields its number, and the number its ids.  The automaton is one file of flat
arrays that Spark ships to every executor and each worker memory-maps.  Words
outside it are merged exactly by the rank rules.

The vocabulary file is that of a public tokenizer: NFC, white space to a blank,
lower case; words by a fixed pattern; byte-level symbols with a word end mark.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pulsekit.llm.common import materialise, table, text_batches

#: Words compiled into the automaton, the most frequent of the corpus first.
LEXICON_WORDS = 1 << 16
#: Words longer than this (bytes) are merged, not compiled.
LEXICON_BYTES = 48
#: Words that a worker remembers before it starts anew, and characters that it holds at once.
MEMO_WORDS = 400_000
SLICE_CHARS = 1_000_000


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


_HIGH = re.compile("[\u0557-\U0010ffff]")
#: Letters and digits that the tokenizer's word pattern does not count as such, being younger than its tables.
LATE_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C,
    0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550,
    0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168,
    0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE,
    0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
#: Lower case of capitals younger than Python's Unicode tables (single ones, then runs with their distance).
LATE_LOWER = ({0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
              | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)})


class Vocabulary:
    """Merge ranks and ids of a BPE vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {tuple(p): i for i, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.names = np.full(size, "", object)
        for name, i in [*self.ids.items(), *self.special.items()]:
            self.names[i] = name
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        # byte-level symbols: printable bytes stand for themselves, the others for 256 upwards in order
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (b for b in range(256) if b not in shown)
        self.symbol = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def split(self, text: str) -> list[str]:
        """The words of a text, special tokens among them."""
        if "<|" in text and self.cut.search(text):
            return [w for part in self.cut.split(text) for w in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        # lower-casing goes by single characters: no final form of sigma
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        if _HIGH.search(text):
            late, words = self.late
            if late.search(text):
                return words.findall(text.lower().translate(LATE_LOWER))
        return self.words.findall(text.lower())

    @cached_property
    def ascii_words(self) -> re.Pattern:
        """The word pattern within lower-cased ASCII, for the plain regular expressions."""
        return re.compile(self.words.pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\t-\r a-z0-9]").replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]"))

    @cached_property
    def late(self) -> tuple:
        """What finds a late letter, and the word pattern without them."""
        young = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATE_LETTERS)
        words = (self.words.pattern.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{young}])+")
                 .replace(r"[\p{L}]+", rf"[\p{{L}}--[{young}]]+").replace(r"|[\p{N}]|", rf"|[\p{{N}}--[{young}]]|"))
        return regex.compile(f"[{young}{''.join(map(chr, LATE_LOWER))}]"), regex.compile(words, regex.V1)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of mergeable id pairs, with the rank and the merged id of each."""
        known = [(self.ids[a] << 32 | self.ids[b], r, self.ids[a + b]) for (a, b), r in self.rank.items()
                 if a in self.ids and b in self.ids and a + b in self.ids]
        return tuple(np.array(sorted(known), np.int64).reshape(-1, 3).T.copy())

    @cached_property
    def bytes_to_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single bytes inside a word and at its end."""
        return (np.array([self.ids.get(self.symbol[b], -1) for b in range(256)]),
                np.array([self.ids.get(self.symbol[b] + self.end, -1) for b in range(256)]))

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (as bytes) of each word by the rank rules: always the leftmost pair of lowest rank.

        Words of one length go together.  In each round every unfinished word merges
        one pair, so all of them stay equally long.
        """
        out: list[bytes] = [b""] * len(words)
        keys, ranks, merged = self.pairs
        none = len(self.rank)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        for size, rows in by_size.items():
            if not size:
                continue
            raw = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(-1, size)
            ids = self.bytes_to_ids[0][raw]
            ids[:, -1] = self.bytes_to_ids[1][raw[:, -1]]
            at = np.array(rows)
            while len(at):
                rank = np.full((len(at), max(1, ids.shape[1] - 1)), none)
                if ids.shape[1] > 1 and len(keys):
                    pair = ids[:, :-1] << 32 | ids[:, 1:]
                    pos = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
                    rank = np.where(keys[pos] == pair, ranks[pos], none)
                first = rank.argmin(axis=1)
                row = np.arange(len(at))
                open_ = rank[row, first] < none
                flat, n = ids[~open_].astype("<u4").tobytes(), 4 * ids.shape[1]
                for k, i in enumerate(at[~open_].tolist()):
                    out[i] = flat[k * n:(k + 1) * n]
                if not open_.any():
                    break
                ids, at, first, row = ids[open_], at[open_], first[open_], row[open_]
                new = merged[pos[row, first]]
                rest = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, rest + (rest > first[:, None]), axis=1)
                ids[np.arange(len(at)), first] = new
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (as bytes) of words and special tokens."""
        out = self.merge([b"" if w in self.special else w.encode("utf-8", "surrogatepass") for w in words])
        return [np.array([self.special[w]], "<u4").tobytes() if w in self.special else o for w, o in zip(words, out)]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(filter(None, self.names[ids[ids < len(self.names)]].tolist()))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# -- the automaton ---------------------------------------------------------------

def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic automaton of ``entries`` (word -> ids) as one block of flat arrays.

    Words are added in byte order.  The part of the previous word beyond the
    common prefix can no longer change, so its states are frozen from the end:
    equal ones (same finality, same arcs) are shared.
    """
    words = sorted(entries)
    frozen: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []          # frozen: (final, ((label, target), ...))
    path: list[list] = [[False, []]]               # open states of the last word: [final, arcs]
    labels: list[int] = []

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            at = frozen.get(key)
            if at is None:
                at = frozen[key] = len(states)
                states.append(key)
            path[-1][1].append((labels.pop(), at))

    last = b""
    for word in words:
        same = len(os.path.commonprefix([last, word]))
        freeze(same)
        for b in word[same:]:
            path.append([False, []])
            labels.append(b)
        path[-1][0] = True
        last = word
    freeze(0)
    states.append((path[0][0], tuple(path[0][1])))
    # numbers below each state; targets come before their sources
    below = np.zeros(len(states), np.int64)
    keys, targets, skips = [], [], []
    for s, (final, arcs) in enumerate(states):
        n = int(final)
        for label, t in arcs:
            keys.append(s * 256 + label)
            targets.append(t)
            skips.append(n)
            n += int(below[t])
        below[s] = n
    ids = [entries[w] for w in words]
    arrays = {"key": np.array(keys, "<i8"), "target": np.array(targets, "<i8"), "skip": np.array(skips, "<i8"),
              "final": np.array([s[0] for s in states], "<i8"),
              "start": np.cumsum([0, *map(len, ids)]).astype("<i8"), "ids": np.array([i for x in ids for i in x], "<u4")}
    head, body = {}, b""
    for name, a in arrays.items():
        head[name] = [len(body), len(a), a.dtype.str]
        body += a.tobytes() + b"\0" * (-a.nbytes % 8)
    first = json.dumps(head).encode()
    first += b" " * (-(len(first) + 8) % 8)
    return len(first).to_bytes(8, "little") + first + body


class Lexicon:
    """A compiled automaton, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int.from_bytes(self.map[:8], "little")
        for name, (at, size, kind) in json.loads(self.map[8:8 + n]).items():
            setattr(self, name, np.frombuffer(self.map, kind, size, 8 + n + at))

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Ids (as bytes) of the words that it holds, else None; all words walk in step."""
        if not words or not len(self.key):
            return [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        state = np.full(len(words), len(self.final) - 1)
        number = np.zeros(len(words), np.int64)
        state[size > LEXICON_BYTES] = -1
        live = np.flatnonzero((state >= 0) & (size > 0))
        at = 0
        while len(live):
            key = state[live] * 256 + text[start[live] + at]
            pos = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[pos] == key
            state[live[~hit]] = -1
            live, pos = live[hit], pos[hit]
            number[live] += self.skip[pos]
            state[live] = self.target[pos]
            at += 1
            live = live[size[live] > at]
        ok = (state >= 0) & (size > 0)
        ok[ok] = self.final[state[ok]] == 1
        lo, hi = self.start[number], self.start[number + 1] if len(self.start) > 1 else self.start[number]
        return [self.ids[a:b].tobytes() if o else None for o, a, b in zip(ok.tolist(), lo.tolist(), hi.tolist())]


def count_words(docs: DataFrame, path: str) -> DataFrame:
    """(word, n) over all texts, summed per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, seen = vocabulary(path), Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in batches:
            for text in batch.column(0):
                seen.update(voc.split(text.as_py() or ""))
                if len(seen) > MEMO_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    return text_batches(docs).select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> list[str]:
    """All words that occur more often than some count, the least one that leaves at most ``words`` of them.

    The count is found from how many words have each count, so no more than ``words`` rows ever reach the driver.
    """
    counted = materialise(count_words(docs, path).where(F.octet_length("word") <= LEXICON_BYTES))
    upto = W.orderBy(F.col("n").desc())            # a row per distinct count: few, as counts add up to the corpus
    sizes = counted.groupBy("n").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.sum("c").over(upto))
    least = sizes.where(F.col("upto") <= words).agg(F.min("n")).first()[0]
    if least is None:
        return []
    return sorted(r["word"] for r in counted.where(F.col("n") >= least).select("word").collect())


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all texts (at most ``words``), ship the file to the executors; its name there."""
    names = frequent_words(docs, path, words)
    voc = vocabulary(path)
    block = compile_lexicon({w.encode(): np.frombuffer(x, "<u4").tolist() for w, x in zip(names, voc.encode_words(names))})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)   # the driver's copy, from which Spark serves the file
    with open(local, "wb") as f:
        f.write(block)
    docs.sparkSession.sparkContext.addFile(local)
    return name


class Encoder:
    """Encodes texts in a worker: automaton first, exact merges for the rest."""

    def __init__(self, path: str, lexicon: str):
        self.voc, self.lexicon, self.memo = vocabulary(path), Lexicon(SparkFiles.get(lexicon)), {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        memo = self.memo
        split = [self.voc.split(t) for t in texts]
        new = [w for w in set().union(*split) if w not in memo]
        found = self.lexicon.find([w.encode("utf-8", "surrogatepass") for w in new])
        memo.update((w, f) for w, f in zip(new, found) if f is not None)
        unseen = [w for w, f in zip(new, found) if f is None]
        memo.update(zip(unseen, self.voc.encode_words(unseen)))
        return [b"".join([memo[w] for w in ws]) for ws in split]


@lru_cache(maxsize=2)
def encoder(path: str, lexicon: str) -> Encoder:
    return Encoder(path, lexicon)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, path: str, lexicon: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as (doc_id, ids array<int>); null and empty texts have no ids."""

    def run(batches):
        enc = encoder(path, lexicon)
        for b in batches:
            at = 0
            for part in _slices([t or "" for t in b.column(1).to_pylist()]):
                out = enc(part)
                ids = pa.array(np.frombuffer(b"".join(out), "<i4"))
                ends = np.cumsum([0, *(len(x) // 4 for x in out)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "ids"])
                at += len(part)

    return text_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) back to (doc_id, text): token strings joined by blanks, special ones kept."""

    def run(batches):
        voc = vocabulary(path)
        for b in batches:
            texts = [voc.decode(np.asarray(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, lexicon: str) -> DataFrame:
    """Encode, decode and digest within one task: the ids themselves need not leave the worker."""

    def run(batches):
        enc = encoder(path, lexicon)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for part in _slices([t or "" for t in b.column(1).to_pylist()]):
                for ids in enc(part):
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(enc.voc.decode(np.frombuffer(ids, "<u4")).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), default_vocabulary()
    return round_trip(docs, path, build_lexicon(docs, path))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: (doc_id, source, n_tokens, ids), one row per row of ``docs``.

    The encoder runs on whole rows, so repeated rows (a mix repeats documents) stay repeated.
    """
    path = default_vocabulary()
    lexicon = build_lexicon(docs, path)

    def run(batches):
        enc = encoder(path, lexicon)
        for b in batches:
            at = 0
            for part in _slices([t or "" for t in b.column(2).to_pylist()]):
                out = enc(part)
                size = np.array([len(x) // 4 for x in out], np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                               pa.array(np.frombuffer(b"".join(out), "<i4")))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), b.column(1).slice(at, len(part)), pa.array(size), ids],
                                                 ["doc_id", "source", "n_tokens", "ids"])
                at += len(part)

    return text_batches(docs).select("doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, n_tokens long, ids array<int>")
