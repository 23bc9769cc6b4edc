"""Quality rules from repetition coverage.

Words become integers per batch; rolling hashes of windows of several lengths
are built by doubling in numpy over the words of all texts of the batch at once,
and windows that occur twice or more in their own text mark the words (hence
characters) that they cover. The same is done for lines.

A text fails the method's rules when the characters inside duplicated windows
of ``n`` words, or inside lines that occur twice or more, exceed a share of all
its word characters (``LIMITS``). Null texts count as empty: no words, all
counts 0, ``base_failed`` true. Shares equal to a limit pass. Rows are independent of each
other, so repeated rows are judged alike; very long texts are measured whole and an empty
table gives no rows. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import WORD, map_columns, table, texts

#: Window length in words -> largest share of word characters inside duplicated windows. Below the base rule's 20 % of
#: words, which rejects by itself whatever a higher limit would.
LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
#: Largest share of word characters on lines that occur twice or more.
LINE_LIMIT = 0.20
BASE_WINDOW = 5
_SYMBOLS = b"#*$%&|<>"

# Odd 64-bit multipliers (from the fractional digits of square roots of 2 and 3).
_STEP = np.uint64(0x6A09E667F3BCC909)
_MIX = np.uint64(0xBB67AE8584CAA73B)


def _power(n: int) -> np.uint64:
    with np.errstate(over="ignore"):
        p = np.uint64(1)
        for _ in range(n):
            p = p * _STEP
    return p


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def window_hashes(x: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Polynomial hashes of all windows of each length; entry i covers x[i : i + n]."""

    def joined(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> np.ndarray:
        size = max(0, len(x) - n_a - n_b + 1)
        return a[:size] * _power(n_b) + b[n_a : n_a + size]

    twos, n = {1: x}, 1
    while 2 * n <= max(lengths):
        twos[2 * n] = joined(twos[n], n, twos[n], n)
        n *= 2
    got = {}
    for want in lengths:
        parts = sorted((k for k in twos if want & k), reverse=True)
        h, have = twos[parts[0]], parts[0]
        for n in parts[1:]:
            h, have = joined(h, have, twos[n], n), have + n
        got[want] = h
    return got


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys)
    ranked = keys[order]
    hit = np.zeros(len(keys), bool)
    same = ranked[1:] == ranked[:-1]
    hit[1:] |= same
    hit[:-1] |= same
    out = np.empty(len(keys), bool)
    out[order] = hit
    return out


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a window of ``n`` that starts at a marked position."""
    edge = np.zeros(size + 1, np.int32)
    edge[:size] = starts
    if n <= size:
        edge[n:] -= starts[: size + 1 - n]
    return np.cumsum(edge[:size]) > 0


def repetition(bodies: list[str], lengths: list[int]) -> dict[str, np.ndarray]:
    """Per text: words, word characters, symbols, later copies of lines, words and characters in duplicated windows and lines."""
    raw = [t.encode() for t in bodies]
    split = [b.split() for b in raw]
    n_words = np.array([len(w) for w in split], np.int64)
    ids: dict[bytes, int] = {}
    flat = [ids.setdefault(w, len(ids)) for words in split for w in words]
    word = np.array(flat, np.int64)
    lengths_of = np.array([len(w) if w.isascii() else len(w.decode()) for w in ids], np.int64)
    chars = lengths_of[word] if len(word) else word
    doc = np.repeat(np.arange(len(bodies)), n_words)
    ends = np.repeat(np.cumsum(n_words), n_words)
    out = {
        "n_words": n_words,
        "word_chars": np.bincount(doc, chars, len(bodies)).astype(np.int64),
        "n_symbols": np.array([len(b) - len(b.translate(None, _SYMBOLS)) for b in raw], np.int64),
    }
    values = _spread(word.astype(np.uint64) + np.uint64(1))
    salt = _spread(doc.astype(np.uint64) + np.uint64(0x9E3779B9))
    for n, h in window_hashes(values, lengths).items():
        starts = np.flatnonzero(np.arange(len(h)) + n <= ends[: len(h)])
        hit = np.zeros(len(word), bool)
        hit[starts] = repeated(_spread(h[starts]) ^ salt[starts])
        inside = covered(hit, n, len(word))
        out[f"words_{n}"] = np.bincount(doc, inside, len(bodies)).astype(np.int64)
        out[f"chars_{n}"] = np.bincount(doc, chars * inside, len(bodies)).astype(np.int64)
    dup, line_chars = np.zeros(len(bodies), np.int64), np.zeros(len(bodies), np.int64)
    for i, b in enumerate(raw):
        lines = b.split(b"\n")
        if len(lines) < 2 or len(set(lines)) == len(lines):
            continue
        seen: dict[bytes, int] = {}
        for x in lines:
            seen[x] = seen.get(x, 0) + 1
        for x, k in seen.items():
            if k > 1 and (w := x.split()):
                dup[i] += k - 1
                line_chars[i] += k * sum(len(y) if y.isascii() else len(y.decode()) for y in w)
    return out | {"n_dup_lines": dup, "line_chars": line_chars}


def quality_rules(
    docs: DataFrame,
    limits: dict[int, float] | None = None,
    line_limit: float = LINE_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: base counts, the largest shares and the verdict ``kept``."""
    limits = dict(sorted((limits or LIMITS).items()))
    lengths = sorted({BASE_WINDOW, *limits})

    def make():
        def call(ids, bodies):
            r = repetition(bodies, lengths)
            failed = (r["n_words"] < 10) | (100 * r[f"words_{BASE_WINDOW}"] > 20 * r["n_words"])
            total = np.maximum(r["word_chars"], 1)
            shares = [r[f"chars_{n}"] / total for n in limits]
            lines = r["line_chars"] / total
            kept = ~failed & (lines <= line_limit)
            for s, most in zip(shares, limits.values(), strict=True):
                kept &= s <= most
            base = [r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", f"words_{BASE_WINDOW}")]
            return [ids, *base, failed, kept, *shares, lines]

        return call

    kind = docs.schema[id_col].dataType.simpleString()
    extra = "".join(f", dup_{n}gram_chars double" for n in limits)
    schema = (
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        f"base_failed boolean, kept boolean{extra}, dup_line_chars double"
    )
    return map_columns(texts(docs, id_col, text_col), make, schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def _window_sql() -> tuple[str, str, str, str, str]:
    """For each window length: its windows, marks of duplicated ones, words covered, their sums, and shares within the limits."""
    lengths = sorted({BASE_WINDOW, *LIMITS})
    marks = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 AS d{n}" for n in lengths)
    grams = ", ".join(f"unnest([array_to_string(ws[i:i + {n - 1}], ' ') FOR i IN range(1, len(ws) - {n - 2})]) AS g{n}" for n in lengths)
    inside = ", ".join(f"max(d{n}::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    sums = ", ".join(f"sum(c{n})::BIGINT AS w{n}, sum(c{n} * length(word))::BIGINT AS x{n}" for n in lengths)
    return grams, marks, inside, sums, " AND ".join(f"dup_{n}gram_chars <= {most}" for n, most in sorted(LIMITS.items()))


_GRAMS, _MARKS, _INSIDE, _SUMS, _WITHIN = _window_sql()

OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, {_GRAMS} FROM d),
m AS (SELECT doc_id, i, word, {_MARKS} FROM p),
c AS (SELECT doc_id, word, {_INSIDE} FROM m),
s AS (SELECT doc_id, sum(length(word))::BIGINT AS word_chars, {_SUMS} FROM c GROUP BY doc_id),
l AS (SELECT doc_id, line, count(*) AS k, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
    FROM d, unnest(string_split(t, chr(10))) AS u(line) GROUP BY ALL),
r AS (SELECT doc_id, sum(k - 1)::BIGINT AS n_dup_lines, sum(k * chars) AS line_chars FROM l WHERE k > 1 AND chars > 0 GROUP BY doc_id),
a AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(word_chars, 0) AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(w{BASE_WINDOW}, 0) AS n_repeat_words, greatest(coalesce(word_chars, 0), 1) AS total,
    {", ".join(f"(coalesce(x{n}, 0) / total)::DOUBLE AS dup_{n}gram_chars" for n in sorted(LIMITS))},
    (coalesce(line_chars, 0) / total)::DOUBLE AS dup_line_chars
  FROM d LEFT JOIN s USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {_WITHIN} AND dup_line_chars <= {LINE_LIMIT} AS kept,
  {", ".join(f"dup_{n}gram_chars" for n in sorted(LIMITS))}, dup_line_chars
FROM a
"""
