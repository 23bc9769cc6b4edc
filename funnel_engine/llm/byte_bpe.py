"""Byte-level BPE encoding and decoding on Spark by a queue of merge ranks.

A pre-token starts as its bytes. A pair of neighbours can merge if the joined bytes
have a rank; the lowest rank merges first, the leftmost pair of it before others.
The queue keeps the pairs in one bucket per rank, as positions of a linked list, under
two levels of bitmaps: words of 256 bits, one bit per rank, and a top word with a bit
for each of those. Find-first-set in both leads to the lowest rank in use.
A merge changes its neighbours' pairs without looking for their old entries; such
stale entries are skipped when they come up. A pre-token of n bytes costs some n
log n steps, however long it is.

Texts are cut into pre-tokens by the pattern; each is encoded by itself, whole if it
is a token. The ids of distinct short pre-tokens are kept by a worker.

Rows are independent: null and empty texts have no ids and no bytes; repeated rows,
ties and null ids come back as they are, and an empty table gives none. Special
strings are ordinary text. Whole texts of any length are encoded. Only the named
columns are read, so further columns may have any name.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_columns, table, texts

#: Distinct pre-tokens in each of a worker's two caches (together some 200 MB at most), and the longest of them.
CACHE = 500_000
CACHE_CHARS = 64

_BIT = [1 << i for i in range(256)]
#: The usual pattern where all characters beyond ASCII are letters, for the quicker ``re``.
_SPACE = r" \t\n\r\x0b\x0c"
_LETTERS = r"A-Za-z\x80-\U0010ffff"
_PLAIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_SPACE}{_LETTERS}0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
).findall


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are their ids."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _Packed(dict):
    """Pre-tokens to their ids as int32 bytes. Long ones are not kept; a full cache keeps those used again."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge
        self.old: dict[str, bytes] = {}

    def __missing__(self, pretoken: str) -> bytes:
        ids = self.old.get(pretoken)
        if ids is None:
            ids = array("i", self.merge(pretoken.encode())).tobytes()
        if len(pretoken) <= CACHE_CHARS:
            self[pretoken] = ids
        return ids

    def age(self) -> None:
        """Make room: what the last ``CACHE`` pre-tokens did not use is forgotten."""
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


class ByteCodec:
    """Encoder and decoder for a rank file in which every single byte is a token."""

    def __init__(self, path: str, pattern: str | None = None):
        import public_tokenizers
        import regex

        self.ranks = read_ranks(path)
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte must have a rank")
        self.pattern = public_tokenizers.PATTERN if pattern is None else pattern
        self.find = regex.compile(self.pattern).findall
        self.plain = _PLAIN if self.pattern == public_tokenizers.PATTERN else self.find
        #: The rank queue, empty between pre-tokens: positions by rank, and the bits of the ranks.
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * ((max(self.ranks.values()) >> 8) + 1)
        self.packed = _Packed(self.merge)
        self.letters: set[str] = set()
        self.stand_ins: dict[str, str] = {}
        # All tokens' bytes in one array, by id.
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id])
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)

    # -- pre-tokens -------------------------------------------------------

    def _stand_in(self, c: str) -> str:
        """A character that this Python's Unicode does not know, as one of the class that the tokenizer library has it in."""
        import tiktoken

        def joins(before: str) -> bool:
            ranks = {bytes([b]): b for b in range(256)} | {(before + c).encode(): 256}
            probe = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            return len(probe.encode_ordinary(before + c)) == 1

        return next((of_class for of_class, before in (("ª", "a"), ("²", "1"), ("!", "!")) if joins(before)), "　")

    def pretokens(self, text: str) -> list[str]:
        """The pattern's matches, with the tokenizer library's classes of characters.

        The libraries know different versions of Unicode, so code points that are new to either are looked up.
        """
        if not text.isascii():
            new = set(text) - self.letters
            for c in [c for c in new if c > "\x7f"]:
                kind = unicodedata.category(c)
                if kind[0] == "L":
                    self.letters.add(c)
                elif kind == "Cn" and c not in self.stand_ins:
                    self.stand_ins[c] = self._stand_in(c)
            new -= self.letters
            if self.stand_ins and not new.isdisjoint(self.stand_ins):
                cuts = np.cumsum([0, *map(len, self.find(text.translate(str.maketrans(self.stand_ins))))]).tolist()
                return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            if any(c > "\x7f" for c in new):
                return self.find(text)
        return self.plain(text)

    # -- encoding ---------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token's bytes."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        rank_of, buckets, words, top = ranks.get, self.buckets, self.words, 0
        n = len(data)
        # Parts are known by where they begin: the next one's begin, the one before, the rank of a part with the next.
        after = list(range(1, n + 2))
        before = list(range(-1, n))
        pair = [rank_of(data[i : i + 2], -1) for i in range(n)]
        pair[-1] = -1
        changed = range(n)  # parts whose pairs are new
        while True:
            for i in changed:
                rank = pair[i]
                if rank < 0:
                    continue
                if rank in buckets:
                    heappush(buckets[rank], i)
                    continue
                buckets[rank] = [i]
                at = rank >> 8
                word = words[at]
                if not word:
                    top |= 1 << at
                words[at] = word | _BIT[rank & 255]
            # The leftmost position of the lowest rank that is not stale: neither of the pair has merged meanwhile.
            while top:
                at = (top & -top).bit_length() - 1
                word = words[at]
                rank = at << 8 | (word & -word).bit_length() - 1
                bucket = buckets[rank]
                if len(bucket) > 1:
                    i = heappop(bucket)
                else:
                    i = bucket[0]
                    del buckets[rank]
                    words[at] = word = word & word - 1
                    if not word:
                        top &= top - 1
                if pair[i] == rank:
                    break
            else:
                break
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = -1
            if end < n:
                before[end] = i
                pair[i] = rank_of(data[i : after[end]], -1)
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                pair[left] = rank_of(data[left:end], -1)
                changed = i, left
            else:
                changed = (i,)
        out = []
        i = 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as int32."""
        self.packed.age()
        return np.frombuffer(b"".join(map(self.packed.__getitem__, self.pretokens(text))), np.int32)

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids in turn."""
        lengths = self.lengths[ids]
        shift = self.begins[ids] - (np.cumsum(lengths) - lengths)
        return self.blob[np.arange(lengths.sum()) + np.repeat(shift, lengths)].tobytes()


_CODECS: dict[str, ByteCodec] = {}


def codec(path: str) -> ByteCodec:
    """One codec per worker process and rank file, with its bounded cache."""
    if path not in _CODECS:
        _CODECS[path] = ByteCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each whole text and the bytes that they decode to."""
    path = path or ranks_path()

    def make():
        c = codec(path)

        def call(keys, bodies):
            ids = [c.encode(t) for t in bodies]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            return [keys, lists, [c.decode(x) for x in ids]]

        return call

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(texts(docs, id_col, text_col), make, f"doc_id {kind}, ids array<int>, decoded binary", 128)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
