"""Secret scans: fixed patterns, and probabilistic automata inferred from the credentials they find.

The known credentials of each kind make a prefix tree whose states are merged where a Hoeffding test
finds no difference between their continuations; every other candidate token is scored by its
likelihood in each automaton against that of an ordinary token, and added where the format wins.

Cases, by definition: a null or empty text has no spans; whole texts are read; a kind with too few
examples has no automaton and adds nothing; repeated rows have the same spans; extra columns stay; offsets count code points; a token of six characters or more, with digits or without, is scored whole.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import SAMPLE, Covered, Span, digest, joined, sampled
from .store import fresh

#: Fixed values, in this order.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: Candidates: the alphabet and least length of an assigned credential.
LEAST = 6
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST},}}")
_ORDINARY = re.compile(r"[A-Za-z0-9+/_=.-]{4,}")
_DIGIT = re.compile(r"[0-9]")

#: Labelled credentials of a kind that an automaton is inferred from: at most and at least; ordinary tokens at most.
EXAMPLES, ENOUGH, ORDINARY = 300, 12, 4000
#: Characters of a labelled credential or ordinary token that the fit takes, whole; longer ones are not fitted on, yet scored.
LONGEST = 512
ALPHA = 0.05
#: Mean gain per character, in nats, of a format over an ordinary token.
MARGIN = 0.8
#: Gain of the whole token, so that a short one needs as much evidence as one of sixteen characters.
WHOLE = 16 * MARGIN
#: Judgements that a process remembers, of tokens of at most so many characters.
REMEMBERED, SHORT = 200_000, 40
END = ""


def base_spans(text: str | None) -> list[Span]:
    """The spans of the fixed patterns, by start and kind."""
    return [s for s, _ in _base(text)]


def _base(text: str | None) -> list[tuple[Span, str]]:
    """Spans with the credential in each."""
    if not text:
        return []
    out = [((0, m.start(), m.end()), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6] if _MARK.search(text) else []
    if "AKIA" in text:
        out += [((1, m.start(), m.end()), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [((2, m.start(), m.end()), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0][1], x[0][0]))


_MARK = re.compile(r"[:=]")


class Automaton:
    """A deterministic automaton with the count of each transition; the empty symbol ends a string."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.moves: list[dict[str, int]] = [{}]
        self.counts: list[Counter] = [Counter()]
        for s in strings:
            at = 0
            for c in s:
                self.counts[at][c] += 1
                if c not in self.moves[at]:
                    self.moves[at][c] = len(self.moves)
                    self.moves.append({})
                    self.counts.append(Counter())
                at = self.moves[at][c]
            self.counts[at][END] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.alphabet = len({c for s in strings for c in s}) + 1
        self._merge()

    def _differ(self, a: int, b: int) -> bool:
        one, two = self.counts[a], self.counts[b]
        n, m = sum(one.values()), sum(two.values())
        if not n or not m:
            return False
        most = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return any(abs(one[c] / n - two[c] / m) > most for c in one.keys() | two.keys())

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if self._differ(a, b):
                return False
            stack += [(self.moves[a][c], t) for c, t in self.moves[b].items() if c in self.moves[a] and self.moves[a][c] != t]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.counts[a] += self.counts[b]
            for c, t in self.moves[b].items():
                if c in self.moves[a]:
                    stack.append((self.moves[a][c], t))
                else:
                    self.moves[a][c] = t

    def _merge(self) -> None:
        """Red-blue merging: a blue state joins the first red one that is compatible, or turns red."""
        red = [0]
        while True:
            kept = set(red)
            blue = [(r, c, t) for r in red for c, t in sorted(self.moves[r].items()) if t not in kept]
            if not blue:
                break
            r, c, t = max(blue, key=lambda x: sum(self.counts[x[2]].values()))
            into = next((q for q in red if self._compatible(q, t)), None)
            if into is None:
                red.append(t)
            else:
                self.moves[r][c] = into
                self._fold(into, t)
        self.states = red
        self.tables = {q: ({c: math.log((n + 0.5) / (sum(self.counts[q].values()) + 0.5 * (self.alphabet + 1))) for c, n in self.counts[q].items()}, math.log(0.5 / (sum(self.counts[q].values()) + 0.5 * (self.alphabet + 1)))) for q in red}
        self.seen = frozenset(c for q in red for c in self.counts[q])

    def log_likelihood(self, s: str) -> float:
        """Of the string and its end; an unknown move restarts at the root at a price."""
        at, total = 0, 0.0
        for c in s:
            known, other = self.tables[at]
            total += known.get(c, other if c in self.seen else -12.0)
            at = self.moves[at].get(c, 0)
            if at not in self.tables:
                at = 0
        known, other = self.tables[at]
        return total + known.get(END, other)


class Ordinary:
    """Likelihood of tokens that are no credentials, by pairs of characters."""

    def __init__(self, tokens: list[str]):
        self.pairs, self.ones = Counter(), Counter()
        for t in tokens:
            for a, b in zip(" " + t, t + " "):
                self.pairs[a, b] += 1
                self.ones[a] += 1

    def log_likelihood(self, s: str) -> float:
        return sum(math.log((self.pairs[a, b] + 0.2) / (self.ones[a] + 0.2 * 70)) for a, b in zip(" " + s, s + " "))


class Formats:
    def __init__(self, automata: dict[int, Automaton], ordinary: Ordinary):
        self.automata, self.ordinary = automata, ordinary
        self.known: dict[str, int | None] = {}

    def judge(self, token: str) -> int | None:
        """The kind whose format explains the token better than ordinary text does, or none."""
        if not self.automata:
            return None
        base = self.ordinary.log_likelihood(token)
        gain, kind = max(((a.log_likelihood(token) - base) / len(token), -k) for k, a in self.automata.items())
        return -kind if gain > max(MARGIN, WHOLE / len(token)) else None

    def recall(self, token: str) -> int | None:
        """``judge``, remembered for tokens that are common because they are short."""
        if len(token) > SHORT:
            return self.judge(token)
        if token not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = self.judge(token)
        return self.known[token]


def added_spans(text: str | None, base: list[Span], formats: Formats) -> list[Span]:
    if not text or not formats.automata:
        return []
    out, covered = [], Covered(base)
    for m in _TOKEN.finditer(text):
        token = m[0].strip("._=/+-")
        if len(token) < LEAST or (kind := formats.recall(token)) is None:
            continue
        start = m.start() + m[0].index(token)
        if not covered.meets(start, start + len(token)):
            out.append((kind, start, start + len(token)))
    return out


def fit(known: list[tuple[int, str]], ordinary: list[str]) -> Formats:
    automata = {}
    for kind in range(len(KINDS)):
        strings = sorted(s for k, s in known if k == kind)
        if len(strings) >= ENOUGH:
            automata[kind] = Automaton(strings)
    return Formats(automata, Ordinary(ordinary))


def _known_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, values, words = [], [], set()
        for text in batch.column("text").to_pylist():
            base = _base(text)
            covered = Covered([s for s, _ in base])
            for (k, _, _), value in base:
                if len(value) <= LONGEST:
                    kinds.append(k)
                    values.append(value)
            for m in _ORDINARY.finditer(text):
                if len(m[0]) > LONGEST or covered.meets(m.start(), m.end()):
                    continue
                if len(m[0]) >= 12 or _DIGIT.search(m[0]):
                    kinds.append(-1)
                    values.append(m[0])
                else:
                    words.add(m[0])
        kinds += [-2] * len(words)
        values += sorted(words)
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.string())], names=["kind", "value"])


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE, examples: int = EXAMPLES, ordinary: int = ORDINARY) -> Formats:
    """Fit on a bounded number of labelled credentials and ordinary tokens of a bounded sample, in hash order."""
    from .store import materialize

    found = materialize(sampled(docs, id, text, sample).mapInArrow(_known_batches, "kind int, value string"), "secret-examples")
    take = lambda k, n: [r["value"] for r in found.where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(n).collect()]
    known = [(k, v) for k in range(len(KINDS)) for v in take(k, examples)]
    # long tokens and those with digits, and plain words, each once
    words = found.where("kind = -2").select("value").distinct().orderBy(F.xxhash64("value"), "value").limit(ordinary).collect()
    return fit(known, take(-1, ordinary) + [r["value"] for r in words])


def span_udf(formats: Formats):
    import pandas as pd

    schema = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(schema)
    def spans(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base = base_spans(text)
            every = sorted(base + added_spans(text, base, formats), key=lambda s: (s[1], s[0]))
            counts = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
            rows.append((*counts, digest(base, KINDS), joined(every, KINDS), [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in every]))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "found"])

    return spans


def with_spans(df: DataFrame, formats: Formats, text: str = "text", out: str = "secrets") -> DataFrame:
    """``df`` with a struct of counts, digest and spans, named ``out`` or that and underscores where a column is so named; no shuffle."""
    return df.withColumn(fresh(df, out), span_udf(formats)(F.col(text)))
