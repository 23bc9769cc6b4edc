"""Secret scan: fixed patterns plus formats inferred from labelled credentials.

The fixed patterns (assignments, access keys, long hex runs) label credentials
in the corpus itself, a bounded sample of distinct values each. Values of one format
(the same length and classes of characters, whatever pattern found them) become a
prefix tree over character classes, whose states are merged when their symbol
and end frequencies are statistically compatible (Hoeffding bounds, red-blue
order); values of rarer formats share a tree. The result is a probabilistic automaton
per format, and one for the candidates that no pattern matched. Every candidate run of
the corpus is then scored by its likelihood under each format; those that a format
explains clearly better than the unlabelled one, and as well as its own examples,
become spans of the kind ``format``. Spans of the fixed patterns always stay.

Candidates are runs of letters, digits and ``+/_-`` of at least ``least_chars``
characters (``LEAST_CHARS``) with a digit; ``digit=False`` takes runs of letters too.
Shorter runs, and without that argument runs of letters alone, are never scored: the
arguments trade reach against the words and names that are then scored.

Null and empty texts have no spans, texts of any length are searched whole. Rows are
independent; repeated rows give repeated results, and spans that start at the same place
go by kind. Without labelled credentials in the corpus no span is added; an empty table
gives no rows. Positions are code points, the end exclusive. Only the named columns are
read; ``redact`` passes all others as they are.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_columns, rewrite_text, stored, table, texts

KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
#: Least length of a candidate.
LEAST_CHARS = 16
#: So many distinct values make a format of their own.
LEAST_EXAMPLES = 5

#: Distinct values per label that the automata are learnt from (those with the smallest hashes).
SAMPLE = 500
#: Log odds, in nats, by which a format must beat the unlabelled candidates.
MIN_LOG_ODDS = 3.0
#: Share of a format's own examples whose likelihood per symbol lies below the least that a candidate needs.
LEAST_QUANTILE = 0.05


# -- fixed patterns -------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind number, end, value)`` of the fixed patterns, in order."""
    out = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(w in low for w in _ASSIGN_WORDS):
            out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


@lru_cache
def _candidate(least_chars: int, digit: bool) -> re.Pattern:
    has_digit = "(?=[A-Za-z+/_-]*[0-9])" if digit else ""
    return re.compile(rf"(?<![A-Za-z0-9+/_-]){has_digit}[A-Za-z0-9+/_-]{{{least_chars},}}")


def candidates(text: str, base: list[tuple[int, int, int, str]], least_chars: int = LEAST_CHARS, digit: bool = True) -> list[tuple[int, int, str]]:
    """Runs that might be credentials and that no base span touches."""
    out, k, reach = [], 0, 0
    for m in _candidate(least_chars, digit).finditer(text):
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][2])
            k += 1
        if reach <= m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


# -- probabilistic automata ----------------------------------------------


def _symbol(c: str) -> str:
    """Character classes: upper, hex letter, other lower letter, digit; a symbol stands for itself."""
    if "0" <= c <= "9":
        return "9"
    if "a" <= c <= "f":
        return "a"
    if "g" <= c <= "z":
        return "z"
    return "A" if "A" <= c <= "Z" else c


_CLASSES = 4 + len("+/_.=-")


@dataclass
class Automaton:
    """States as counts of strings that pass (``n``), end (``ends``) and go on by a symbol (``went``, ``to``)."""

    n: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    went: list[dict[str, int]] = field(default_factory=list)
    to: list[dict[str, int]] = field(default_factory=list)

    def _state(self) -> int:
        self.n.append(0)
        self.ends.append(0)
        self.went.append({})
        self.to.append({})
        return len(self.n) - 1

    def add(self, value: str) -> None:
        if not self.n:
            self._state()
        s = 0
        self.n[0] += 1
        for c in map(_symbol, value):
            self.went[s][c] = self.went[s].get(c, 0) + 1
            if c not in self.to[s]:
                self.to[s][c] = self._state()
            s = self.to[s][c]
            self.n[s] += 1
        self.ends[s] += 1

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.n[a], self.n[b]
            if not na or not nb:
                continue
            most = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.ends[a] / na - self.ends[b] / nb) > most:
                return False
            for c in self.went[a].keys() | self.went[b].keys():
                if abs(self.went[a].get(c, 0) / na - self.went[b].get(c, 0) / nb) > most:
                    return False
                if c in self.to[a] and c in self.to[b]:
                    todo.append((self.to[a][c], self.to[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.n[a] += self.n[b]
            self.ends[a] += self.ends[b]
            for c, k in self.went[b].items():
                self.went[a][c] = self.went[a].get(c, 0) + k
                if c in self.to[a]:
                    todo.append((self.to[a][c], self.to[b][c]))
                else:
                    self.to[a][c] = self.to[b][c]

    def merge(self, alpha: float) -> Automaton:
        """Merge compatible states: each frontier state joins the first settled one that it agrees with, or settles."""
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        settled, k = [0], 0
        while k < len(settled):
            s = settled[k]
            for c in sorted(self.to[s]):
                b = self.to[s][c]
                if b in settled:
                    continue
                for r in settled:
                    if self._compatible(r, b, bound):
                        self.to[s][c] = r
                        self._fold(r, b)
                        break
                else:
                    settled.append(b)
            # Folding may have hung new frontier states on earlier settled ones.
            k = next((i for i, r in enumerate(settled) if any(x not in settled for x in self.to[r].values())), len(settled))
        return self

    def log_likelihood(self, value: str) -> float:
        """Smoothed by half a count per symbol and end; a symbol never seen in a state leads back to the start."""
        s, total = 0, 0.0
        for c in map(_symbol, value):
            total += math.log((self.went[s].get(c, 0) + 0.5) / (self.n[s] + 0.5 * (_CLASSES + 1)))
            s = self.to[s].get(c, 0)
        return total + math.log((self.ends[s] + 0.5) / (self.n[s] + 0.5 * (_CLASSES + 1)))


def infer(values: list[str], alpha: float = 0.05) -> Automaton:
    """A probabilistic automaton of the values (in sorted order, so that it depends on the set alone)."""
    a = Automaton()
    for v in sorted(values):
        a.add(v)
    return a.merge(alpha) if a.n else a


@dataclass
class Formats:
    """One automaton per credential label with the least likelihood per symbol it asks for, and the background."""

    known: list[tuple[Automaton, float]]
    other: Automaton
    least_chars: int = LEAST_CHARS
    digit: bool = True

    def odds(self, value: str) -> float:
        """Log odds of the best format that finds the value likely enough; minus infinity if none does."""
        own = [(a.log_likelihood(value), least) for a, least in self.known]
        own = [x for x, least in own if x >= least * (len(value) + 1)]
        if not own:
            return -math.inf
        rest = self.other.log_likelihood(value) if self.other.n else -(len(value) + 1) * math.log(_CLASSES + 1)
        return max(own) - rest


def _shape(value: str) -> tuple[int, str]:
    """Length and classes of characters, which values of one format have in common."""
    return len(value), "".join(sorted(set(map(_symbol, value))))


def infer_formats(labelled: dict[str, list[str]], least_chars: int = LEAST_CHARS, digit: bool = True) -> Formats:
    """An automaton for each format with ``LEAST_EXAMPLES`` labelled values, one for all others, and the background's."""
    shapes: dict[tuple[int, str], set[str]] = {}
    for label in KINDS[:3]:
        for v in labelled.get(label, []):
            shapes.setdefault(_shape(v), set()).add(v)
    groups = [values for _, values in sorted(shapes.items()) if len(values) >= LEAST_EXAMPLES]
    rare = {v for values in shapes.values() if len(values) < LEAST_EXAMPLES for v in values}
    known = []
    for values in [*groups, rare] if rare else groups:
        a = infer(list(values))
        per = sorted(a.log_likelihood(v) / (len(v) + 1) for v in values)
        known.append((a, per[int(LEAST_QUANTILE * len(per))]))
    return Formats(known, infer(labelled.get("none", [])), least_chars, digit)


# -- Spark ----------------------------------------------------------------


def labelled_values(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, digit: bool = True
) -> dict[str, list[str]]:
    """At most ``sample`` distinct values per label, from all documents; ``none`` are candidates without a label."""

    def make():
        def call(_, bodies):
            got = set()
            for t in bodies:
                base = base_spans(t)
                got.update((KINDS[k], v) for _, k, _, v in base)
                got.update(("none", v) for _, _, v in candidates(t, base, least_chars, digit))
            pairs = sorted(got)
            return [[x for x, _ in pairs], [x for _, x in pairs]]

        return call

    found = stored(map_columns(texts(docs, id_col, text_col), make, "label string, value string").distinct(), "labelled-values")
    return {
        k: [r.value for r in found.where(F.col("label") == k).orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
        for k in (*KINDS[:3], "none")
    }


def all_spans(text: str, formats: Formats, least: float = MIN_LOG_ODDS) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of fixed and inferred spans, in order."""
    base = base_spans(text)
    more = [(s, 3, e) for s, e, v in candidates(text, base, formats.least_chars, formats.digit) if formats.odds(v) >= least]
    return sorted([(s, k, e) for s, k, e, _ in base] + more)


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, formats: Formats | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the fixed kinds, their digest, and all spans."""
    formats = formats or infer_formats(labelled_values(docs, SAMPLE, id_col, text_col))

    def make():
        def call(ids, bodies):
            found = [all_spans(t, formats) for t in bodies]
            counts = [[sum(k == kind for _, k, _ in x) for x in found] for kind in range(4)]
            digests = [hashlib.sha256(_listed([y for y in x if y[1] < 3]).encode()).hexdigest() for x in found]
            return [ids, *counts[:3], digests, [_listed(x) for x in found], counts[3]]

        return call

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_format bigint"
    return map_columns(texts(docs, id_col, text_col), make, schema)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, formats: Formats | None = None, mask: str = "[SECRET]", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every span of ``text_col`` masked; a null text stays null, other columns stay as they are."""
    formats = formats or infer_formats(labelled_values(docs, SAMPLE, id_col, text_col))

    def make():
        return lambda bodies: [t and masked(t, all_spans(t, formats), mask) for t in bodies]

    return rewrite_text(docs, text_col, make)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))
