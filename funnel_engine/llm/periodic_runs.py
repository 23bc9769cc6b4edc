"""Periodic runs of words: an online scan over the sparse diagonals of each text.

The word at ``i`` lies on diagonal ``q`` when the word ``q`` places earlier is the
same. The scan reads a text once and holds the match length of every active
diagonal. Earlier occurrences of the word at hand lengthen the diagonals of their
lags, or begin new ones; a diagonal that the word does not lengthen has ended, and
is emitted at once when its stretch (match length + lag) is long enough.

All earlier occurrences of a word would be quadratic in a text that repeats one
word. The scan looks a word up together with the words before it, in contexts of
m = 1, 2, 4, ... words, and takes the latest occurrence of each, for lags in
(m/2, m]. That loses no run and adds none. Let a stretch of smallest period q and
length >= 4 q be given and m/2 < q <= m < 2 q: wherever a context of m words and its
copy q places earlier both lie in the stretch, an occurrence at a smaller lag d would
give the m + d >= q + d words up to there the periods d and q, hence (Fine and Wilf)
a period that divides q, which would be one of the whole stretch. So the latest
occurrence has lag q there, from the first such word to the stretch's end; and in a
stretch with a smaller period than q it never has. A context that occurs once in a
text is left out of the longer ones, so plain prose is done after a few words of
context, and one word repeated n times costs n log n.

Rows are independent: each text is judged by itself, whatever its length; repeated
rows, ties and null ids come back as they are, and an empty table gives none. Null,
empty and blank texts have no words, no runs and an empty collapsed text. Only the
named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_columns, table, texts

#: A run has at least this many words, and this many times its period.
LEAST_WORDS = 6
LEAST_REPEATS = 4
#: Words scanned together: texts of a batch are joined until there are so many (one text is never cut).
TOGETHER = 200_000


def latest_occurrences(words: np.ndarray, place: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """``position, lag, context`` of the latest occurrences that can be a run's, by position.

    ``words`` are numbers of words, no number in two texts; ``place`` are their places in their texts.
    """
    at, key, context = np.arange(len(words)), words, 1
    dense = np.full(len(words), -1)
    found = []
    while len(at):
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        where = at[order]
        lag = np.diff(where)
        hit = same & (lag <= context) & (2 * lag > context)
        found.append((where[1:][hit], lag[hit], np.full(hit.sum(), context)))
        again = np.append(same, False) | np.append(False, same)
        dense[:] = -1
        dense[where[again]] = np.append(0, np.cumsum(~same))[again]
        at = np.flatnonzero(dense >= 0)
        at = at[place[at] >= 2 * context - 1]
        at = at[dense[at - context] >= 0]
        key = dense[at - context] * len(words) + dense[at]
        context *= 2
    if not found:
        return [], [], []
    position, lag, context = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(position, kind="stable")
    return position[order].tolist(), lag[order].tolist(), context[order].tolist()


def scan(occurrences: Iterable[tuple[int, int, int]], least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> Iterator[tuple[int, int, int]]:
    """Runs ``(start, length, period)``, each as soon as its diagonal ends; takes ``(position, lag, context)`` by position."""

    def ended(diagonals: dict[int, int], last: int) -> Iterator[tuple[int, int, int]]:
        for period, match in diagonals.items():
            length = match + period
            if length >= least and length >= repeats * period:
                yield last - length + 1, length, period

    # Match lengths up to the word before the one at hand, and up to that one.
    active: dict[int, int] = {}
    grown: dict[int, int] = {}
    here = -1
    for position, lag, context in occurrences:
        if position != here:
            yield from ended(active, here - 1)
            active, grown = grown, {}
            if position != here + 1:
                yield from ended(active, here)
                active = {}
            here = position
        grown[lag] = active.pop(lag, context - 1) + 1
    yield from ended(active, here - 1)
    yield from ended(grown, here)


def runs_of(texts_words: list[list[bytes]], least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, by start, then period. ``repeats`` must be 4 or more (see the module's proof)."""
    if repeats < 4:
        raise ValueError("repeats must be 4 or more")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts_words]
    numbers: list[int] = []
    begins = [0]
    after = count()
    for words in texts_words:
        number: defaultdict[bytes, int] = defaultdict(after.__next__)
        numbers.extend(map(number.__getitem__, words))
        begins.append(len(numbers))
    all_words = np.array(numbers, np.int64)
    place = np.arange(len(numbers)) - np.repeat(begins[:-1], np.diff(begins))
    # No context crosses two texts, and so no two texts have occurrences at adjacent positions.
    found = sorted(scan(zip(*latest_occurrences(all_words, place), strict=True), least, repeats), key=lambda r: (r[0], r[2]))
    if found:
        homes = np.searchsorted(begins, [r[0] for r in found], "right") - 1
        for home, (start, length, period) in zip(homes.tolist(), found, strict=True):
            out[home].append((start - begins[home], length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    repeats: int = LEAST_REPEATS,
    prepare: Callable[[int | str | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs array<start, length, period>, collapsed`` of each whole text (see the module's notes on odd rows).

    ``prepare`` may change a text's words, given its id, before the scan.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def make():
        def call(ids, bodies):
            n, found, kept = [], [], []
            rows = zip(ids, bodies, strict=True)
            while part := list(word_lists(rows)):
                for words, runs in zip(part, runs_of(part, least, repeats), strict=True):
                    n.append(len(words))
                    found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                    kept.append(b" ".join(collapsed(words, runs)).decode())
            return [ids, n, pa.array(found, run_type), kept]

        def word_lists(rows):
            total = 0
            for key, body in rows:
                words = body.encode().split()
                words = prepare(key, words) if prepare else words
                yield words
                total += len(words)
                if total >= TOGETHER:
                    return

        return call

    schema = f"doc_id {kind}, n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string"
    return map_columns(texts(docs, id_col, text_col), make, schema)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's own input: a tenth of the documents, by the digest of the id, has its tail made periodic. None without an id."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period. Null without runs."""

    def better(best: Column, r: Column) -> Column:
        ahead = r.length * best.period - best.length * r.period
        earlier = (r.start < best.start) | ((r.start == best.start) & (r.period < best.period))
        return F.when((ahead > 0) | ((ahead == 0) & earlier), r).otherwise(best)

    return F.reduce(runs, F.get(runs, F.lit(0)), better)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=repeated_tail)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
