"""Byte-level BPE encoding and decoding by replaying the merges over a whole shard of words.

The distinct words of many texts lie in one flat array of byte tokens.  An index
from token pair (named by the rank of its concatenation) to the positions where it
stands is kept as merges are applied in rank order: every position of the pair is
merged at once, for all words, and only the two neighbours of a merged position get
new entries.  No word is scanned again.  Where a merge lets a pair of lower rank
arise, that rank comes first, as the encoder's rule (the leftmost pair of lowest rank
in each word) demands.

A shard is what one Spark task holds of the corpus, in runs of bounded size; words
met before are remembered up to a bound.  Nothing is shuffled and nothing is sent
to the driver.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from pulsekit.llm.common import table, text_batches

#: Words that a worker remembers before it starts anew, and characters of text that it holds at once.
MEMO_WORDS = 400_000
SLICE_CHARS = 2_000_000
#: Texts below this code point are split by plain regular expressions.
LATIN = 0x250


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


#: The white space characters of Unicode, below LATIN and all.  Python's ``\\s`` also takes U+001C to U+001F.
_SPACE = r"\t-\r \x85\xa0"
_WIDE = _SPACE + r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _class(kind: str) -> str:
    """Characters below LATIN whose general category begins with ``kind``, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c)).startswith(kind))


class Ranks:
    """A rank file: byte strings by rank, and the splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            entries = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in entries}
        self.size = max(self.rank.values(), default=-1) + 1
        self.names: list[bytes] = [b""] * self.size
        for name, r in self.rank.items():
            self.names[r] = name
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self.decimal = [str(i) for i in range(self.size)]
        self.first = np.array([self.rank.get(bytes([b]), -1) for b in range(256)])
        #: a * size + b -> rank of the concatenation, for every way to cut a token in two
        self.pair = {self.rank[a] * self.size + self.rank[b]: r for name, r in self.rank.items()
                     for i in range(1, len(name)) if (a := name[:i]) in self.rank and (b := name[i:]) in self.rank}
        #: the same for two bytes, as a table
        self.bytes_pair = np.full((256, 256), -1, np.int64)
        for name, r in self.rank.items():
            if len(name) == 2 and self.first[name[0]] >= 0 and self.first[name[1]] >= 0:
                self.bytes_pair[name[0], name[1]] = r
        self.words = regex.compile(_white(pattern))
        self.high = re.compile(f"[{chr(LATIN)}-\U0010ffff]")
        inner = {r"\p{L}": _class("L"), r"\p{N}": _class("N"), r"\s": _SPACE}
        plain = pattern
        for name, chars in inner.items():
            plain = plain.replace(name, f"\0{chars}\0")
        # a name inside a class gives its characters, one that stands alone a class of its own
        out, depth, i = [], 0, 0
        while i < len(plain):
            if plain[i] == "\0":
                j = plain.index("\0", i + 1)
                out.append(plain[i + 1:j] if depth else f"[{plain[i + 1:j]}]")
                i = j + 1
                continue
            depth += (plain[i] == "[") - (plain[i] == "]")
            out.append(plain[i])
            i += 1
        self.latin = re.compile("".join(out).replace(r"\S", f"[^{_SPACE}]"))

    def split(self, text: str) -> list[str]:
        """The matches of the pattern in a text."""
        return (self.words if self.high.search(text) else self.latin).findall(text)

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids; ids outside the file stand for nothing."""
        names, size = self.names, self.size
        return b"".join([names[i] for i in ids if 0 <= i < size])

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit bytes.  A word that is a token needs no merge."""
        out = [b""] * len(words)
        open_ = []
        for i, w in enumerate(words):
            r = self.rank.get(w)
            if r is None:
                open_.append(i)
            else:
                out[i] = self.packed[r]
        for i, ids in zip(open_, self.replay([words[i] for i in open_])):
            out[i] = ids
        return out

    def replay(self, words: list[bytes]) -> list[bytes]:
        """All merges over all ``words`` in rank order; ids of each as little-endian 32-bit bytes."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        if not n:
            return [b""] * len(words)
        first = self.first[raw]
        if (first < 0).any():
            raise ValueError("a byte of the text has no rank")
        inner = np.ones(n, bool)                      # a pair starts here: not at a word's last byte
        inner[stop[size > 0] - 1] = False
        start = np.zeros(n, bool)
        start[(stop - size)[size > 0]] = True
        rank = np.full(n, -1)
        rank[:-1] = self.bytes_pair[raw[:-1], raw[1:]]
        rank[~inner] = -1
        # the index: positions of each pair, in order
        order = np.argsort(rank, kind="stable")
        order = order[np.searchsorted(rank[order], 0):]
        keys, cuts = np.unique(rank[order], return_index=True)
        index = {k: a.tolist() for k, a in zip(keys.tolist(), np.split(order, cuts[1:]))} if len(keys) else {}
        heap = list(index)
        heapq.heapify(heap)
        tok, at_rank = first.tolist(), rank.tolist()
        after = np.where(inner, np.arange(1, n + 1), -1).tolist()
        before = np.where(start, -1, np.arange(-1, n - 1)).tolist()
        dead = bytearray(n)
        pair, base, push = self.pair.get, self.size, heapq.heappush
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r)
            places.sort()
            for k, p in enumerate(places):
                if at_rank[p] != r:                   # merged away, or part of another pair by now
                    continue
                q = after[p]
                z = after[q]
                tok[p] = r
                dead[q] = 1
                at_rank[q] = -1
                after[p] = z
                low = r
                if z >= 0:
                    before[z] = p
                    new = at_rank[p] = pair(r * base + tok[z], -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            push(heap, new)
                        if new < low:
                            low = new
                else:
                    at_rank[p] = -1
                o = before[p]
                if o >= 0:
                    new = at_rank[o] = pair(tok[o] * base + r, -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(o)
                        else:
                            index[new] = [o]
                            push(heap, new)
                        if new < low:
                            low = new
                if low < r:                           # a lower rank goes first, then the rest of this one
                    if rest := places[k + 1:]:
                        index[r] = rest
                        push(heap, r)
                    break
        live = np.frombuffer(dead, np.uint8) == 0
        flat = np.array(tok, np.int64)[live].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(live)])[np.concatenate([[0], stop])] * 4
        ends = ends.tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]


def _white(pattern: str) -> str:
    """The pattern with Unicode white space in place of ``\\s`` and ``\\S``."""
    out, depth, i = [], 0, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two in (r"\s", r"\S"):
            out.append(_WIDE if depth else f"[{'^' if two == r'\S' else ''}{_WIDE}]")
            i += 2
            continue
        depth += (pattern[i] == "[") - (pattern[i] == "]")
        out.append(pattern[i])
        i += 1
    return "".join(out)


class Encoder:
    """Encodes texts in a worker and remembers the words that it has met."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.memo = Ranks(path, pattern), {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        memo = self.memo
        split = [self.ranks.split(t) for t in texts]
        new = [w for w in set().union(*split) if w not in memo]
        memo.update(zip(new, self.ranks.encode_words([w.encode("utf-8") for w in new])))
        return [b"".join([memo[w] for w in ws]) for ws in split]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _runs(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as (doc_id, ids array<int>).

    Null and empty texts have no ids; a null doc_id stays null; repeated rows stay repeated;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            at = 0
            for part in _runs([t or "" for t in b.column(1).to_pylist()]):
                out = enc(part)
                ends = np.cumsum([0, *(len(x) // 4 for x in out)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(out), "<i4")))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), ids], ["doc_id", "ids"])
                at += len(part)

    return text_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) back to (doc_id, bytes binary); null ids and ids outside the file stand for nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = encoder(path, pattern).ranks
        for b in batches:
            out = [ranks.decode([i for i in x or [] if i is not None]) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode and digest within one task: (doc_id, n_tokens, ids_sha256, decoded_sha256), a row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        decimal = enc.ranks.decimal
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for part in _runs([t or "" for t in b.column(1).to_pylist()]):
                for packed in enc(part):
                    ids = np.frombuffer(packed, "<u4").tolist()
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(enc.ranks.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_ranks(), default_pattern())
