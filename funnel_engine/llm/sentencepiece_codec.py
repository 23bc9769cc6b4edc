"""SentencePiece BPE encoding and decoding on Spark, without the library's encoder.

A merge-type encoding is the only segmentation into vocabulary pieces whose
adjacent pairs are all *compatible*: re-merging the text of the pair alone gives
the pair back. So one pass of an Aho-Corasick automaton lists the pieces that
start at each position; the encoder takes the longest that is compatible with
its predecessor, falls back to shorter ones, and steps back when none is left. A
bitfield remembers positions that failed, so each position fails at most once.

Texts are cut only where no vocabulary piece can cross (before a space mark that
follows something else, around line ends, between a letter and punctuation after
a word), and each distinct segment of a task is encoded once.

Null and empty texts give no ids and an empty decoded text. Rows are
independent: repeated rows, ties and null ids come back as they are. Very long texts are
encoded whole; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_columns, table, texts

MARK = "▁"
#: Punctuation after a word; cut off where no piece holds a letter and one of these in turn.
_MARKS = ".,;:!?*#$%&|"
#: Distinct segments (with and without a space mark) and compatible pairs kept within a
#: task, some 150 MB at most; a full cache starts anew.
CACHE = 400_000
CACHE_BARE = 100_000
CACHE_PAIRS = 250_000


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memo(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class PieceCodec:
    """Encoder and decoder for a SentencePiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only BPE models with identity normalisation are supported")
        kinds = model.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.fallback = spec.byte_fallback
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.unk = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.text_of = {i: p.replace(MARK, " ") for p, i in self.ids.items()}
        self.unk_text = spec.unk_surface or " ⁇ "
        self.words_apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.letters_apart = not any(p[k].isalpha() and p[k + 1] in _MARKS for p in self.ids for k in range(len(p) - 1))
        self.id_text = {p: f",{i}" for p, i in self.ids.items()}
        self.lines_apart = not any("\n" in p for p in self.ids)
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        #: The longest shorter piece that a piece starts with; its first character alone if there is none.
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in self.ids), p[0]) for p in self.ids if len(p) > 1}
        self.fits: dict[tuple[str, str], bool] = {}
        self.marked = _Memo(lambda w: self._ids_text(MARK + w))
        self.bare = _Memo(self._ids_text)
        # Decimal ids of pieces and of bytes that are characters by themselves.
        self.shown = {str(i): t for i, t in self.text_of.items()} | {str(i): chr(b) for i, b in self.byte_of.items() if b < 128}

    # -- encoding ---------------------------------------------------------

    def _remerge(self, text: str) -> list[str]:
        """Merge the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: str, right: str) -> bool:
        if len(self.fits) >= CACHE_PAIRS:
            self.fits.clear()
        ok = self.fits[left, right] = self._remerge(left + right) == ([left, right] if left else [right])
        return ok

    def pieces(self, segment: str) -> list[str]:
        n = len(segment)
        longest: list[str | None] = [None] * n
        for end, (before_end, piece) in self.automaton.iter(segment):
            longest[end - before_end] = piece  # ends ascend, so the longest of a start comes last
        failed = None  # a bitfield, made when a position fails
        fits, shorter = self.fits, self.shorter
        out: list[str] = []
        at, before = 0, ""
        while at < n:
            piece = longest[at] or segment[at]  # a character outside the vocabulary stands alone
            while piece is not None:
                end = at + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    ok = fits.get((before, piece))
                    if ok is None:
                        ok = self._compatible(before, piece)
                    if ok:
                        break
                piece = shorter.get(piece)
            if piece is None:
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(out.pop())
                before = out[-1] if out else ""
            else:
                out.append(piece)
                at, before = end, piece
        return out

    def _segment_ids(self, segment: str) -> list[int]:
        out: list[int] = []
        for p in self.pieces(segment):
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out.extend(self.byte[b] for b in p.encode())
            elif not out or out[-1] != self.unk:  # adjacent unknown characters are one id
                out.append(self.unk)
        return out

    def _ids_text(self, segment: str) -> str:
        if not segment:
            return ""
        if self.letters_apart and segment[-1] in _MARKS:
            stem = segment.rstrip(_MARKS)
            if stem and stem[-1].isalpha():
                cache, key = (self.marked, stem[1:]) if stem[0] == MARK else (self.bare, stem)
                return cache[key] + self.bare[segment[len(stem) :]]
        try:
            return "".join([self.id_text[p] for p in self.pieces(segment)])
        except KeyError:  # characters outside the vocabulary
            return "".join(f",{i}" for i in self._segment_ids(segment))

    def forget(self) -> None:
        """Empty the segment caches."""
        self.marked.clear()
        self.bare.clear()

    def encoded_segments(self, text: str) -> list[str]:
        """The ids of each segment as ``,1,2``; their concatenation is the whole encoding."""
        if not text:
            return []
        if len(self.marked) > CACHE:
            self.marked.clear()
        if len(self.bare) > CACHE_BARE:
            self.bare.clear()
        text = self.prefix + text.replace(" ", MARK)
        if not (self.words_apart and self.lines_apart and self.fallback):
            return [self._ids_text(text)]
        out: list[str] = []
        newline = self.bare["\n"]
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(newline)
            if MARK + MARK in line:
                out.extend(map(self.bare.__getitem__, re.split(f"(?<=[^{MARK}])(?={MARK})", line)))
            else:
                first, *rest = line.split(MARK)
                if first:
                    out.append(self.bare[first])
                out.extend(map(self.marked.__getitem__, rest))
        return out

    def encode(self, text: str) -> list[int]:
        joined = "".join(self.encoded_segments(text))
        return [int(x) for x in joined[1:].split(",")] if joined else []

    # -- decoding ---------------------------------------------------------

    def _plain(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i is not None:
                out.append(self.unk_text if i == self.unk else self.text_of.get(i, ""))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self._plain(ids)
        return text[1:] if self.prefix and text.startswith(" ") else text

    def decode_joined(self, joined: str) -> str:
        """Decode ids given as ``,1,2``."""
        if not joined:
            return ""
        listed = joined[1:].split(",")
        try:
            text = "".join(map(self.shown.__getitem__, listed))
        except KeyError:  # bytes of longer characters, unknown or control ids
            return self.decode([int(x) for x in listed])
        return text[1:] if self.prefix and text.startswith(" ") else text


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec per worker process and model; only its segments go when a task ends."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each whole text and the text that they decode to."""
    path = path or model_path()

    def make():
        c = codec(path)

        def call(ids, bodies):
            got = [c.encode(t) for t in bodies]
            return [ids, got, [c.decode(x) for x in got]]

        call.finish = c.forget
        return call

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(texts(docs, id_col, text_col), make, f"doc_id {kind}, ids array<int>, decoded string", 128)


def encoding_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each whole text (see the module's notes on edge cases)."""
    path = path or model_path()

    def make():
        c = codec(path)
        sha = hashlib.sha256

        def call(ids, bodies):
            n, a, b = [], [], []
            for t in bodies:
                joined = "".join(c.encoded_segments(t))
                n.append(joined.count(","))
                a.append(sha(joined[1:].encode()).hexdigest())
                b.append(sha(c.decode_joined(joined).encode()).hexdigest())
            return [ids, n, a, b]

        call.finish = c.forget
        return call

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(texts(docs, id_col, text_col), make, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"))
