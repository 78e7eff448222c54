"""Operator 11 - secret scans by grammar inference.

Three fixed patterns find labelled credentials (``assign``, ``access``, ``hex``).
From a bounded sample of each kind's distinct credentials a probabilistic automaton
is inferred: the sample's prefix tree, whose states are merged as long as a
Hoeffding test finds the frequencies of their endings and of all that follows
compatible. Unlabelled candidates (long runs of credential characters that no base
span touches) give one more automaton, ``plain``.

Every candidate is then scored by its format: the log2 likelihood under a kind's
automaton less that under ``plain``. It becomes a span ``format_<kind>`` when the
score outweighs how much rarer that kind is than candidates, with ``MARGIN`` bits to
spare. Base spans always stay; a base span's score is that of its credential.

Bounds: ``PER_KIND`` distinct strings of each kind, those with the smallest hash, of
at most ``FIT_CHARS`` characters each (longer ones are scored as all others, but not
learned from). How often each kind occurs is counted over all texts.

Defined results: null text counts as empty and has no span; a repeated row has the
same spans again; without labelled credentials only base spans are reported.
Extra columns pass through, those named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import map_arrow, mixed, stored, text_chunks, drop_stored

#: The base patterns and the least length of a credential.
PATTERNS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
KINDS = list(PATTERNS)
#: Words without which the pattern ``assign`` finds nothing.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Parameters: strings of a kind to learn from and their length, shortest candidate, significance of the merge
#: test, weight of an unseen step, bits by which a candidate must outweigh the rarity of its kind.
PER_KIND, FIT_CHARS, SHORTEST, ALPHA, UNSEEN, MARGIN = 512, 256, 16, 0.05, 0.5, 10.0
PLAIN = "plain"
SYMBOLS = 68  # credential characters and the end
SPAN = "struct<kind:string,start:int,end:int,score:double>"

_ASSIGN = re.compile(PATTERNS["assign"][0], re.I | re.A)
_ACCESS = re.compile(PATTERNS["access"][0])
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs that are long enough
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind's place, kind, credential's end ...) of the base patterns, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= PATTERNS["assign"][2]:
                out.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= PATTERNS["access"][2]]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    out.sort(key=lambda s: s[:2])
    return out


def candidates(text: str, base: list[tuple]) -> list[tuple[int, int, str]]:
    """Long runs of credential characters that no base span touches."""
    found = [(m.start(), m.end(), m[0]) for m in _CANDIDATE.finditer(text)]
    if not base or not found:
        return found
    # The furthest end of the base spans that start before a candidate's end tells whether one touches it.
    starts = np.array([s[0] for s in base])
    reach = np.maximum.accumulate([s[2] for s in base])
    last = np.searchsorted(starts, [f[1] for f in found], "left") - 1
    return [f for f, k in zip(found, last.tolist()) if k < 0 or reach[k] <= f[0]]


class Automaton:
    """A probabilistic automaton: ``count[q]`` arrivals, ``end[q]`` endings, ``step[q]``: symbol -> [next, times]."""

    def __init__(self, strings: list[str] = (), alpha: float = ALPHA):
        self.count, self.end, self.step = [0], [0], [{}]
        for s in strings:
            self._add(s)
        if strings:
            self._merge_states(alpha)

    def _add(self, s: str):
        q = 0
        self.count[0] += 1
        for c in s:
            edge = self.step[q].get(c)
            if edge is None:
                self.count.append(0)
                self.end.append(0)
                self.step.append({})
                edge = self.step[q][c] = [len(self.count) - 1, 0]
            edge[1] += 1
            q = edge[0]
            self.count[q] += 1
        self.end[q] += 1

    def _merge_states(self, alpha: float):
        """States in breadth-first order: each is merged into the first settled state it is compatible with, or settles."""
        width = math.sqrt(0.5 * math.log(2 / alpha))
        settled, waiting = [0], deque((0, c) for c in sorted(self.step[0]))
        while waiting:
            parent, c = waiting.popleft()
            q = self.step[parent][c][0]
            if q in settled:
                continue
            home = next((p for p in settled if self._compatible(p, q, width)), None)
            if home is None:
                settled.append(q)
                waiting.extend((q, x) for x in sorted(self.step[q]))
            else:
                before = {p: set(self.step[p]) for p in settled}
                self.step[parent][c][0] = home
                self._fold(home, q)
                # Folding may give settled states new steps; they wait like the others.
                waiting.extend((p, x) for p in settled for x in sorted(set(self.step[p]) - before[p]))
        name = {q: i for i, q in enumerate(settled)}
        self.count, self.end = [self.count[q] for q in settled], [self.end[q] for q in settled]
        self.step = [{c: [name[t], n] for c, (t, n) in self.step[q].items()} for q in settled]

    def _compatible(self, p: int, q: int, width: float) -> bool:
        todo = [(p, q)]
        while todo:
            a, b = todo.pop()
            na, nb = self.count[a], self.count[b]
            limit = width * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.end[a] / na - self.end[b] / nb) > limit:
                return False
            x, y = self.step[a], self.step[b]
            for c, (t, n) in y.items():
                other = x.get(c)
                if abs((other[1] / na if other else 0) - n / nb) > limit:
                    return False
                if other:
                    todo.append((other[0], t))
            if any(n / na > limit for c, (_, n) in x.items() if c not in y):
                return False
        return True

    def _fold(self, p: int, q: int):
        todo = [(p, q)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.end[a] += self.end[b]
            for c, (t, n) in self.step[b].items():
                edge = self.step[a].get(c)
                if edge is None:
                    self.step[a][c] = [t, n]
                else:
                    edge[1] += n
                    todo.append((edge[0], t))

    def log2(self, s: str) -> float:
        """Log2 probability of a string; an unseen step has a small probability and leads back to the start."""
        q, total = 0, 0.0
        for c in s:
            edge = self.step[q].get(c)
            seen = edge[1] if edge else 0
            total += math.log2((seen + UNSEEN / SYMBOLS) / (self.count[q] + UNSEEN))
            q = edge[0] if edge else 0
        return total + math.log2((self.end[q] + UNSEEN / SYMBOLS) / (self.count[q] + UNSEEN))


class Grammar:
    """The automata of all kinds, and what a candidate's score must reach for each."""

    def __init__(self, automata: dict[str, Automaton], occurrences: dict[str, int]):
        self.automata = automata
        many = max(occurrences.get(PLAIN, 0), 1)
        self.least = {k: MARGIN + max(0.0, math.log2(many / max(occurrences.get(k, 0), 1))) for k in automata if k != PLAIN}

    def score(self, kind: str, s: str) -> float | None:
        own = self.automata.get(kind)
        return None if own is None else own.log2(s) - self._plain(s)

    def _plain(self, s: str) -> float:
        plain = self.automata.get(PLAIN)
        return plain.log2(s) if plain else -(len(s) + 1) * math.log2(SYMBOLS)

    def name(self, s: str) -> tuple[str, float] | None:
        """The kind whose format a candidate has, and its score."""
        if not self.least:
            return None
        plain = self._plain(s)
        best, kind = max((self.automata[k].log2(s) - plain, k) for k in self.least)
        return (kind, best) if best >= self.least[kind] else None


def _learned(docs: DataFrame, text: str) -> DataFrame:
    """(kind, value, h, n, total) of strings to learn from; in each task the smallest hashes of each kind."""

    def run(it):
        found: dict[str, Counter] = {}
        total: Counter = Counter()

        def flush():
            rows = [(k, s, n) for k, c in found.items() for s, n in c.items()]
            found.clear()
            counts = dict(total)
            total.clear()
            return {"kind": [*(r[0] for r in rows), *counts], "value": [*(r[1] for r in rows), *[None] * len(counts)],
                    "n": [*(r[2] for r in rows), *counts.values()]}

        for _, texts in text_chunks(it, text):
            for t in texts:
                base = base_spans(t)
                for kind, s in [(KINDS[b[1]], b[3]) for b in base] + [(PLAIN, c[2]) for c in candidates(t, base)]:
                    total[kind] += 1
                    if len(s) <= FIT_CHARS:
                        found.setdefault(kind, Counter())[s] += 1
            for k, c in found.items():
                if len(c) > 8 * PER_KIND:  # only the smallest hashes can be chosen in the end
                    found[k] = Counter({s: c[s] for s in sorted(c, key=_order)[:PER_KIND]})
        yield flush()

    return map_arrow(docs.select(F.col(f"`{text}`").alias(text)), run, "kind string, value string, n long")


def _order(s: str) -> tuple[int, str]:
    return int(mixed(np.array([int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little")], np.uint64))[0] >> np.uint64(1)), s


def fit(docs: DataFrame, text: str = "text") -> Grammar:
    """Learn the automata: a bounded sample of each kind's strings, each automaton in a task of its own."""
    rows = stored(_learned(docs, text), "credentials")
    occurrences = {r[0]: r[1] for r in rows.where("value is null").groupBy("kind").agg(F.sum("n")).collect()}

    def hashed(it):
        for b in it:
            yield {"kind": b.column("kind"), "value": b.column("value"), "h": [_order(s)[0] for s in b.column("value").to_pylist()]}

    distinct = map_arrow(rows.where("value is not null").select("kind", "value").distinct(), hashed, "kind string, value string, h long")
    place = F.row_number().over(Window.partitionBy("kind").orderBy("h", "value"))
    sample = distinct.withColumn("r", place).where(F.col("r") <= PER_KIND).select("kind", "value", "h")

    def infer(key, table):
        # At most PER_KIND strings of FIT_CHARS characters.
        a = Automaton([s for _, s in sorted(zip(table.column("h").to_pylist(), table.column("value").to_pylist()))])
        q, c, t, n = zip(*[(q, c, t, n) for q, e in enumerate(a.step) for c, (t, n) in e.items()])
        return pa.table({"kind": [key[0].as_py()], "count": [a.count], "ends": [a.end], "q": [list(q)], "c": [list(c)], "t": [list(t)],
                         "n": [list(n)]})

    shape = "kind string, count array<long>, ends array<long>, q array<long>, c array<string>, t array<long>, n array<long>"
    automata = {}
    for r in sample.groupBy("kind").applyInArrow(infer, shape).collect():  # one bounded row a kind
        a = automata[r["kind"]] = Automaton()
        a.count, a.end, a.step = list(r["count"]), list(r["ends"]), [{} for _ in r["count"]]
        for q, c, t, n in zip(r["q"], r["c"], r["t"], r["n"]):
            a.step[q][c] = [t, n]
    drop_stored(rows)
    return Grammar(automata, occurrences)


def all_spans(text: str, grammar: Grammar) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, score) of base and format spans, by start, then kind as listed."""
    base = base_spans(text)
    out = [(b[0], b[1], b[2], KINDS[b[1]], grammar.score(KINDS[b[1]], b[3])) for b in base]
    for s, e, c in candidates(text, base):
        got = grammar.name(c)
        if got:
            out.append((s, len(KINDS) + KINDS.index(got[0]), e, f"format_{got[0]}", got[1]))
    out.sort(key=lambda x: x[:2])
    return [(k, s, e, v) for s, _, e, k, v in out]


def find_secrets(docs: DataFrame, grammar: Grammar | None = None, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``: an array of (kind, start, end, score); positions count code points, the end is exclusive."""
    grammar = grammar or fit(docs, text)
    plain = {k: (a.count, a.end, a.step) for k, a in grammar.automata.items()}
    sent = docs.sparkSession.sparkContext.broadcast((plain, grammar.least))  # bounded: see PER_KIND and FIT_CHARS
    kept = docs.drop(out)
    full = StructType([*kept.schema.fields, *StructType.fromDDL(f"`{out}` array<{SPAN}>").fields])

    def run(it):
        parts, least = sent.value
        g = Grammar({}, {})
        for k, (count, end, step) in parts.items():
            a = g.automata[k] = Automaton()
            a.count, a.end, a.step = count, end, step
        g.least = least
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(full)
        for b, texts in text_chunks(it, text):
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in all_spans(t, g)] for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, schema.field(len(schema) - 1).type)], schema=schema)

    return kept.mapInArrow(run, full)


def span_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_query(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans, spans found by format alone."""
    df = find_secrets(docs.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(KINDS))

    def of_kind(k: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")

    return df.select("doc_id", *[of_kind(k) for k in KINDS], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"),
                     (F.size("secrets") - F.size(base)).cast("long").alias("n_format"))
