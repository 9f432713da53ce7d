"""Secret scan by grammar inference from labelled credentials.

1. *Spans.*  One pass over the whole texts finds the base spans (assignments, access keys,
   hexadecimal keys) and all other long runs of credential characters that mix letters
   and digits, the candidates.
   What is kept of a text is these strings and where they stand (code points, end
   exclusive).
2. *Automata.*  The base spans label their values as credentials of a kind.  For each kind
   a prefix tree of a bounded sample is built and its states are merged where their
   ending and branching frequencies are statistically compatible (Hoeffding's bound, the
   test applied to all that follows), which gives a probabilistic automaton of the
   format.  One more automaton is inferred from candidates, as what strings look like.
3. *Scores.*  Every candidate is scored by each format's likelihood.  It is a secret if the
   best one explains it far better than the automaton of all candidates does, and about
   as well as it explains its own examples.

Samples are the first SAMPLE distinct values in hash order of each kind, of at most
SAMPLE_CHARS characters; both are bounds of what the driver holds.  All candidates are
scored, at full length.

Defined results: a null or empty text has no spans; a kind without labelled values has no
automaton, and without any of them nothing is added; repeated rows are scanned alike;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugemill.llm.common import arrow_slices, joined, materialize, sha256_hex

SAMPLE = 400
SAMPLE_CHARS = 128
CANDIDATE_CHARS = 16
SIGNIFICANCE = 0.05
# A secret is this many times likelier (natural logarithm) under a format than as a candidate.
MIN_LOG_ODDS = 9.0
# Slack below the per-character likelihood of a format's own examples.
SLACK = 0.35

KINDS = ["assign", "access", "hex", "grammar"]

# Base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % CANDIDATE_CHARS)
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string())])
_SPANS = "array<struct<start: long, end: long, kind: string, value: string>>"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) by start, then kind; leftmost and non-overlapping per kind."""
    out = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        out += [(*m.span(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(*m.span(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(*m.span(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Long mixed runs of credential characters that touch no base span."""
    out, nearest = [], 0
    ends = []
    for a, b, _, _ in base:
        ends.append((a, max(b, ends[-1][1] if ends else 0)))
    for m in CANDIDATE.finditer(text):
        if not DIGIT.search(m[0]) or not LETTER.search(m[0]):
            continue
        a, b = m.span()
        while nearest < len(ends) and ends[nearest][1] <= a:
            nearest += 1
        if nearest == len(ends) or ends[nearest][0] >= b:
            out.append((a, b, "grammar", m[0]))
    return out


def found_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, candidates) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in _SPAN]
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                base, other = [], []
                for text in part.column("text"):
                    whole = text.as_py() or ""
                    spans = base_spans(whole)
                    base.append([dict(zip(names, s)) for s in spans])
                    other.append([dict(zip(names, s)) for s in candidates(whole, spans)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(other, pa.list_(_SPAN))],
                    names=["doc_id", "base", "candidates"],
                )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(run, f"doc_id long, base {_SPANS}, candidates {_SPANS}")


class Automaton:
    """Probabilistic automaton inferred from strings by merging a prefix tree's states.

    A state has its visits, its endings and, by symbol, the next state and how often it
    was taken.
    """

    def __init__(self, samples: list[str], significance: float = SIGNIFICANCE):
        self.visits, self.endings = [0], [0]
        self.steps: list[dict[str, list[int]]] = [{}]
        self.width = math.sqrt(0.5 * math.log(2 / significance))
        for s in samples:
            self._insert(s)
        self._merge_states()
        scores = sorted(self.log_likelihood(s) / (len(s) + 1) for s in samples)
        self.usual = scores[len(scores) // 50] if scores else 0.0

    def _insert(self, text: str) -> None:
        state = 0
        self.visits[0] += 1
        for symbol in text:
            step = self.steps[state].get(symbol)
            if step is None:
                step = self.steps[state][symbol] = [len(self.visits), 0]
                self.visits.append(0)
                self.endings.append(0)
                self.steps.append({})
            step[1] += 1
            state = step[0]
            self.visits[state] += 1
        self.endings[state] += 1

    def _merge_states(self) -> None:
        """Red states are settled; each blue one, a child of a red, is merged or settled."""
        red = [0]
        settled = {0}
        blue = [(0, symbol) for symbol in sorted(self.steps[0])]
        while blue:
            # The most visited first: its frequencies say most.
            blue.sort(key=lambda x: (self.visits[self.steps[x[0]][x[1]][0]], x))
            parent, symbol = blue.pop()
            state = self.steps[parent][symbol][0]
            if state in settled:
                continue
            for target in red:
                if self._compatible(target, state):
                    self.steps[parent][symbol][0] = target
                    self._fold(target, state)
                    break
            else:
                red.append(state)
                settled.add(state)
            blue = [
                (r, s) for r in red for s in sorted(self.steps[r]) if self.steps[r][s][0] not in settled
            ]

    def _close(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) < self.width * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, one: int, two: int) -> bool:
        pending = [(one, two)]
        while pending:
            a, b = pending.pop()
            na, nb = self.visits[a], self.visits[b]
            if not self._close(self.endings[a], na, self.endings[b], nb):
                return False
            for symbol in self.steps[a].keys() | self.steps[b].keys():
                x, y = self.steps[a].get(symbol), self.steps[b].get(symbol)
                if not self._close(x[1] if x else 0, na, y[1] if y else 0, nb):
                    return False
                if x and y:
                    pending.append((x[0], y[0]))
        return True

    def _fold(self, one: int, two: int) -> None:
        """Add the tree below ``two`` to the automaton at ``one``."""
        pending = [(one, two)]
        while pending:
            a, b = pending.pop()
            self.visits[a] += self.visits[b]
            self.endings[a] += self.endings[b]
            for symbol, (target, n) in self.steps[b].items():
                mine = self.steps[a].get(symbol)
                if mine is None:
                    self.steps[a][symbol] = [target, n]
                else:
                    mine[1] += n
                    pending.append((mine[0], target))

    def log_likelihood(self, text: str) -> float:
        """Natural logarithm of the string's probability; unseen steps cost as a rare symbol."""
        state, total = 0, 0.0
        for symbol in text:
            n = self.visits[state]
            step = self.steps[state].get(symbol)
            if step is None:
                total += math.log(0.5 / (n + 1) / 64)
                state = 0
            else:
                total += math.log((step[1] + 0.01) / (n + 1))
                state = step[0]
        return total + math.log((self.endings[state] + 0.05) / (self.visits[state] + 1))


class Grammar:
    """The formats' automata and that of all candidates."""

    def __init__(self, labelled: dict[str, list[str]], plain: list[str]):
        self.formats = {k: Automaton(v) for k, v in sorted(labelled.items()) if len(v) >= 5}
        self.plain = Automaton(plain)

    def score(self, text: str) -> float:
        """Log-odds of the best fitting format against a candidate; -inf if none fits."""
        best = -math.inf
        for automaton in self.formats.values():
            found = automaton.log_likelihood(text)
            if found / (len(text) + 1) >= automaton.usual - SLACK:
                best = max(best, found)
        return best - self.plain.log_likelihood(text) if best > -math.inf else best


def infer(found: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Automata from bounded samples of a stored table of spans."""

    def first(column: str, kind: str) -> list[str]:
        value = found.select(F.explode(column).alias("s")).filter(
            (F.col("s.kind") == kind) & (F.length("s.value") <= SAMPLE_CHARS)
        ).select("s.value").distinct()
        return [r[0] for r in value.orderBy(F.xxhash64("value"), "value").limit(sample).collect()]

    labelled = {kind: first("base", kind) for kind in KINDS[:-1]}
    return Grammar(labelled, first("candidates", KINDS[-1]))


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256, spans, and ``found`` (all spans with values)."""
    stored = materialize(found_spans(docs), "secrets")
    shared = docs.sparkSession.sparkContext.broadcast(infer(stored, sample))
    names = ["n_assign", "n_access", "n_hex", "n_grammar"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        for batch in batches:
            counts, digests, texts, all_found = [], [], [], []
            for base, other in zip(batch.column("base"), batch.column("candidates")):
                base = base.as_py() or []
                added = [c for c in other.as_py() or [] if grammar.score(c["value"]) >= MIN_LOG_ODDS]
                both = sorted(base + added, key=lambda s: (s["start"], KINDS.index(s["kind"])))
                flat = [(s["start"], s["end"], s["kind"]) for s in both]
                counts.append([sum(1 for s in both if s["kind"] == k) for k in KINDS])
                digests.append(sha256_hex(joined([s for s in flat if s[2] != KINDS[-1]])))
                texts.append(joined(flat))
                all_found.append(both)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(digests, pa.string()),
                 pa.array(texts, pa.string()), pa.array(all_found, pa.list_(_SPAN))],
                names=["doc_id", *names, "base_sha256", "spans", "found"],
            )

    longs = ", ".join(f"{n} long" for n in names)
    return stored.mapInArrow(run, f"doc_id long, {longs}, base_sha256 string, spans string, found {_SPANS}")
