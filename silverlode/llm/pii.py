"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

The field labels whole segments: a segment's score comes from features of all of it (its shape, its
digits, its check sum, the word before it), and dynamic programming over segments of bounded length
chooses boundaries and types together. It is fitted on regions whose patterns are known, on the same
regions with the known spans rewritten in other usual forms, and on look-alikes that are no such data.

Cases, by definition: a null or empty text has no spans; whole texts are read, in time linear in
their length; an entity of more than ``LONGEST`` pieces or ``LONGEST_TEXT`` characters is beyond the
field (not the patterns); with no known span in the sample nothing is added; repeated rows have the same
spans; extra columns stay; offsets count code points.
"""

import itertools
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import SAMPLE, Covered, Span, digest, joined, sampled
from .store import fresh

#: Fixed values, in this order.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Bounds of an entity: pieces (an address spelled out with six words takes 23), and characters.
LONGEST, LONGEST_TEXT = 24, 320
#: Regions of each kind fitted on at most, passes over them.
REGIONS, PASSES, RATE, L2 = 240, 4, 0.3, 1e-3
#: A segment is added if its score beats that of reading its pieces as other text by this.
MARGIN = 2.0
_PIECE = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^\sA-Za-z0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[{] ?(?:at|dot) ?[)\]}]| dot ", re.I)
_REACH = 48


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[Span]:
    """The spans of the fixed patterns, by kind and start."""
    if not text:
        return []
    out: list[Span] = []
    done = edge = 0
    for m in _AT.finditer(text) if "@" in text else ():
        edge = max(done, text.rfind("@", edge, m.start()) + 1)
        piece = text[edge : m.start()]
        start = m.start() - (len(piece) - len(piece.rstrip(LOCAL)))
        edge = m.start()
        if start < m.start():
            out.append((0, start, m.end()))
            done = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around what may belong to personal data; stretches that meet are one."""
    start = end = None
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - _REACH), min(len(text), m.end() + _REACH)
        if end is not None and a <= end:
            end = b
            continue
        if end is not None:
            yield start, end
        start, end = a, b
    if end is not None:
        yield start, end


def _shape(s: str) -> str:
    s = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", s))
    return re.sub(r"(a[._+-]|9[._+-]|a9|9a)+(?=[a9])", "x", s)[:16]


def plausible(kind: int, s: str) -> bool:
    """A bound on what a segment of a kind may be at all."""
    n = len(_digits(s))
    if kind == 0:
        return ("@" in s or re.search(r"\bat\b", s, re.I) is not None) and ("." in s or re.search(r"\bdot\b", s, re.I) is not None) and s[0].isalnum() and s[-1].isalpha()
    if not ("0" <= s[-1] <= "9") or any(c.isalpha() for c in s):
        return False
    if kind == 1:
        return 4 <= n <= 12 and len(re.findall(r"[0-9]+", s)) == 4 and s[0].isdigit() and not re.search(r"[^0-9. ]", s)
    if kind == 2:
        return 16 <= n <= 19 and s[0].isdigit() and not re.search(r"[^0-9 .-]", s)
    return 10 <= n <= 15 and s[0] in "+(0123456789" and not re.search(r"[^0-9 ().+-]|[^0-9+(]{4}", s)


def features(kind: int, s: str, before: str, after: str) -> list[tuple]:
    digits = _digits(s)
    groups = tuple(len(g) for g in re.findall(r"[0-9]+", s))[:6]
    out = [
        (kind, "bias"), (kind, "shape", _shape(s)), (kind, "digits", min(len(digits), 20)), (kind, "first", s[0] if not s[0].isalnum() else "9" if s[0].isdigit() else "a"),
        (kind, "left", bool(before) and before[-1].isalnum()), (kind, "right", bool(after) and (after[0].isalnum() or after[:1] == "." and after[1:2].isdigit())),
        (kind, "at", "@" in s), (kind, "marks", "".join(sorted({c for c in s if not c.isalnum()}))[:6]),
    ]
    if kind == 1:
        out.append((kind, "bytes", all(int(g) <= 255 for g in re.findall(r"[0-9]{1,9}", s))))
    if kind == 2:
        out.append((kind, "luhn", luhn(digits)))
    if kind == 3:
        out.append((kind, "groups", groups))
        out.append((kind, "luhn16", len(digits) > 15))
    word = re.search(r"([A-Za-z]+)\W*$", before[-24:])
    out.append((kind, "word", word[1].lower() if word else ""))
    return out


#: Digits of each numeric kind, at least and at most.
_COUNTS = {1: (4, 12), 2: (16, 19), 3: (10, 15)}


def _sort(piece: str) -> str:
    """``a`` letters, ``9`` digits, ``s`` space, ``n`` space with a line end, ``@`` a sign or word for it, else ``.``."""
    c = piece[0]
    if c.isspace():
        return "n" if "\n" in piece else "s"
    if c == "@" or len(piece) == 2 and piece.lower() == "at":
        return "@"
    return "9" if "0" <= c <= "9" else "a" if c.isascii() and c.isalpha() else "."


class SemiMarkov:
    """Weights of segment features and the lattice that they score; state None is other text."""

    def __init__(self, weights: dict | None = None):
        self.weights = weights or {}

    def lattice(self, text: str) -> tuple[list[int], list[tuple[int, int, int, list]]]:
        """Ends of pieces, and the segments (from piece, to piece, kind, features) that may be entities.

        What a segment holds is counted as it grows, and it is looked at only where the counts allow a kind,
        so the work is in proportion to the text.
        """
        pieces = _PIECE.findall(text)
        cuts, at = [0], 0
        for p in pieces:
            at += len(p)
            cuts.append(at)
        sort = [_sort(p) for p in pieces]
        # the next sign of an address at or after each piece
        sign, ahead = [0] * len(pieces), len(pieces)
        for i in range(len(pieces) - 1, -1, -1):
            ahead = i if sort[i] == "@" else ahead
            sign[i] = ahead
        out = []
        for i, first in enumerate(sort):
            if first in "sn":
                continue
            address, number = first in "a9@" and sign[i] < i + LONGEST, first == "9" or pieces[i] in "+("
            digits = 0
            for j in range(i, min(i + LONGEST, len(pieces))):
                s = sort[j]
                if s == "n" or cuts[j + 1] - cuts[i] > LONGEST_TEXT:
                    break
                if s == "9":
                    digits += len(pieces[j])
                    number = number and digits <= 19
                elif s in "a@":
                    number = False
                if not address and not number:
                    break
                kinds = ((0,) if address and s in "a@" and sign[i] <= j else ()) + ((1, 2, 3) if number and s == "9" and digits >= 4 else ())
                for kind in kinds:
                    if kind == 0 or _COUNTS[kind][0] <= digits <= _COUNTS[kind][1]:
                        span = text[cuts[i] : cuts[j + 1]]
                        if plausible(kind, span):
                            out.append((i, j + 1, kind, features(kind, span, text[max(0, cuts[i] - 32) : cuts[i]], text[cuts[j + 1] : cuts[j + 1] + 4])))
        return cuts, out

    def score(self, found: list) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in found)

    def best(self, text: str) -> list[tuple[int, int, int, float]]:
        """(kind, start, end, score) of the entities of the best segmentation; a piece of other text scores 0."""
        cuts, segments = self.lattice(text)
        by_end = defaultdict(list)
        for i, j, kind, found in segments:
            by_end[j].append((i, kind, self.score(found)))
        value, back = [0.0], [None]
        for j in range(1, len(cuts)):
            value.append(value[-1])
            back.append(None)
            for i, kind, s in by_end[j]:
                if value[i] + s > value[j]:
                    value[j], back[j] = value[i] + s, (i, kind, s)
        out, j = [], len(cuts) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind, s = back[j]
                out.append((kind, cuts[i], cuts[j], s))
                j = i
        return out[::-1]

    def step(self, cuts: list[int], segments: list, gold: set[tuple[int, int, int]], rate: float) -> None:
        """One gradient step on the log-likelihood, by forward and backward sums over segments."""
        scored = [(i, j, kind, found, self.score(found)) for i, j, kind, found in segments]
        n = len(cuts) - 1
        starts, ends = defaultdict(list), defaultdict(list)
        for x in scored:
            starts[x[0]].append(x)
            ends[x[1]].append(x)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _sum([ahead[j - 1], *(ahead[x[0]] + x[4] for x in ends[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _sum([behind[i + 1], *(behind[x[1]] + x[4] for x in starts[i])])
        for i, j, kind, found, s in scored:
            p = math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[n]))
            move = rate * (((cuts[i], cuts[j], kind) in gold) - p)
            for f in found:
                w = self.weights.get(f, 0.0)
                self.weights[f] = w + move - rate * L2 * w


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def variants(kind: int, s: str, rng: random.Random) -> tuple[str, bool]:
    """Another usual form of a known span (True), or a look-alike that is none (False)."""
    roll = rng.random()
    if kind == 0:
        if roll < 0.5:
            return s.replace("@", rng.choice([" at ", " (at) ", " [at] "])).replace(".", rng.choice([" dot ", " (dot) "])), True
        return s.replace("@", " ").replace(".", " "), False
    if kind == 1:
        parts = s.split(".")
        if roll < 0.5:
            return ".".join([*parts[:3], str(rng.randint(256, 999))]), False
        return ".".join(parts[:3]), False
    if kind == 2:
        digits = _digits(s)
        if roll < 0.5:
            return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10), False
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), True
    digits = _digits(s)
    if roll < 0.4:
        return f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", True
    if roll < 0.7:
        return f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", True
    return digits, False


def fit(known: list[tuple[str, list[Span]]], seed: int = 7) -> SemiMarkov:
    """A field fitted on regions and their known spans, and on their variants."""
    rng, model, cases = random.Random(seed), SemiMarkov(), []
    if not any(spans for _, spans in known):
        return model
    for text, spans in known:
        cases.append((text, {(a, b, k) for k, a, b in spans}))
        for k, a, b in spans:
            other, real = variants(k, text[a:b], rng)
            rest = [(x, y) for _, x, y in spans if (x, y) != (a, b)]
            left = max([0, *(y for x, y in rest if y <= a)])
            right = min([len(text), *(x for x, y in rest if x >= b)])
            cases.append((text[left:a] + other + text[b:right], {(a - left, a - left + len(other), k)} if real else set()))
    lattices = [(*model.lattice(t), gold) for t, gold in cases]
    for p in range(PASSES):
        rng.shuffle(lattices)
        for cuts, segments, gold in lattices:
            if segments:
                model.step(cuts, segments, gold, RATE / (1 + p))
    return model


def added_spans(text: str | None, base: list[Span], model: SemiMarkov) -> list[Span]:
    if not text or not model.weights:
        return []
    out, covered = [], Covered(base)
    for a, b in regions(text):
        if all(covered.meets(m.start(), m.end()) for m in _TRIGGER.finditer(text, a, b)):
            continue  # nothing but known spans could start an entity here
        for kind, s, e, score in model.best(text[a:b]):
            if score > MARGIN and not covered.meets(a + s, a + e):
                out.append((kind, a + s, a + e))
    return sorted(set(out))


def _known_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, kinds, starts, ends, ids = [], [], [], [], []
        for id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            base = base_spans(text)
            ordered, first = sorted(base, key=lambda s: s[1:]), 0
            for a, b in regions(text):
                while first < len(ordered) and ordered[first][1] < a:
                    first += 1
                here = sorted(s for s in itertools.takewhile(lambda s, b=b: s[1] < b, itertools.islice(ordered, first, None)) if s[2] <= b)
                texts.append(text[a:b])
                ids.append(f"{id}:{a}")
                kinds.append([k for k, _, _ in here])
                starts.append([s - a for _, s, _ in here])
                ends.append([e - a for _, _, e in here])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string()), *(pa.array(x, pa.list_(pa.int32())) for x in (kinds, starts, ends))], names=["id", "text", "kinds", "starts", "ends"])


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE, limit: int = REGIONS) -> SemiMarkov:
    """Fit on ``limit`` regions of the sample with known spans, and as many without, in hash order; regions of up to ``8 * _REACH`` characters."""
    found = sampled(docs, id, text, sample).mapInArrow(_known_batches, "id string, text string, kinds array<int>, starts array<int>, ends array<int>")
    found = found.where(F.length("text") <= 8 * _REACH)
    order = F.xxhash64("id"), F.col("id")
    parts = [found.where(c).orderBy(*order).limit(n).collect() for c, n in (("size(kinds) > 0", limit), ("size(kinds) = 0", limit))]
    return fit([(r["text"], list(zip(r["kinds"], r["starts"], r["ends"]))) for p in parts for r in p])


def span_udf(model: SemiMarkov):
    import pandas as pd

    schema = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(schema)
    def spans(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base = base_spans(text)
            every = sorted(base + added_spans(text, base, model))
            counts = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
            rows.append((*counts, digest(base, KINDS), joined(every, KINDS), [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in every]))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "found"])

    return spans


def with_spans(df: DataFrame, model: SemiMarkov, text: str = "text", out: str = "pii") -> DataFrame:
    """``df`` with a struct of counts, digest and spans, named ``out`` or that and underscores where a column is so named; no shuffle."""
    return df.withColumn(fresh(df, out), span_udf(model)(F.col(text)))
