"""Benchmark decontamination by template canonicalisation and a hash join of template windows.

Numbers, names and units become typed placeholders. Every item and every document is cut into windows of
five template tokens; windows meet by an equi join on their hashes; and a match counts only if the values
behind the placeholders map one to one between item and document, so a question asked again with other
values is caught, and a chance mixture is not. A capitalised token may be a name or a word, in items and
in documents alike, so windows that hold one are taken under each coding with three words at least.

What keeps the join small, without dropping a match:

- Two bit maps of fixed size, one of the benchmark's words and one of its windows, turn most windows of a
  document away before anything is shuffled; a benchmark that fills them makes the join larger, not wrong.
- A document needs a share of an item's windows, so it holds one at least of any set that leaves fewer
  than that out: the pairs to look at come from the item's windows that are rarest in the documents, and
  a window that is in every document joins nothing but such pairs.
- Equal texts are looked up once.

An item that has too few windows for that, because it is short or made of numbers, is matched by all its
tokens in a row, values included. In scripts without spaces each character is a token.

Cases, by definition: a null or empty document holds nothing; null or empty items, and items without a
letter, digit or sign of measure, are held by nothing; an item without an id is reported under null;
repeated documents are each reported, a repeated item (id and text) once, items of equal text under each
id; whole texts are read; an empty table on either side finds nothing; extra columns stay, and where one
has the name of the new column, that is lengthened by underscores.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import fresh, materialize

WINDOW = 5
#: Words that a window has to hold beside its placeholders.
LEAST_WORDS = 3
#: The share of an item's windows (of those with words enough beside all capitals) that has to be found near one another.
SHARE = 0.8
#: Windows that a template has to need; an item that needs fewer is matched by all its tokens.
FEW = 4
#: Bits of the two maps, as powers of two: 1 MB and 16 MB whatever the benchmark.
WORD_BITS, WINDOW_BITS = 23, 27
#: Words and signs of measure.
UNITS = frozenset(
    "% $ € £ ° mm cm km meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet yard yards "
    "mg kg gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces liter liters litre litres ml gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros "
    "kb mb gb tb volt volts watt watts degree degrees".split()
)
#: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
_DENSE = "\u0e00-\u0e3e\u0e40-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[^\W\d_{_DENSE}]+|(?!\d)[{_DENSE}]|\d+(?:[.,]\d+)*|[%$€£°]")
#: The same where no letter is of a script without spaces, and where all is ASCII.
_SPACED, _ASCII = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[%$€£°]"), re.compile(r"[A-Za-z]+|[0-9]+(?:[.,][0-9]+)*|[%$]")
_BEYOND = re.compile("[\u0e00-\U0010ffff]")
#: Codes of placeholders; words have larger ones, and this bit where they are capitalised and may be names instead.
NUMBER, NAME, UNIT = 1, 2, 3
_EITHER = 1 << 62
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Forms that a process remembers.
_REMEMBERED = 1_000_000
#: Tokens of documents that are looked up at once.
_TOGETHER = 100_000

_HIT = "k1 long, k2 long, at int, kind int, hash long, forms array<string>"
_HIT_SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32()), ("kind", pa.int32()), ("hash", pa.int64()), ("forms", pa.list_(pa.string()))])


# ---- tokens and windows


def forms_of(text: str) -> list[str]:
    """The tokens of a text as written."""
    pattern = _ASCII if text.isascii() else _TOKEN if _BEYOND.search(text) else _SPACED
    return pattern.findall(text)


def tokens(text: str | None) -> list[tuple[str, str]]:
    """(form, kind) of each token; kind is ``number``, ``unit``, ``name`` (capitalised, so perhaps a name) or ``word``."""
    return [(form.lower(), kind_of(form)) for form in forms_of(text or "")]


def kind_of(form: str) -> str:
    if form[0].isdigit():
        return "number"
    if form.lower() in UNITS:
        return "unit"
    return "name" if len(form) > 1 and form[0].isupper() else "word"


def _word_code(low: str) -> int:
    import xxhash

    return (xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")) >> 3) | 8


class _Typed(dict):
    """The template code of each form as written. With a map of words, a word that is not in it has none (0), or is a name."""

    def __init__(self, words: bytes | None = None):
        self.words = words

    def __missing__(self, form: str) -> int:
        kind = kind_of(form)
        if kind in ("number", "unit"):
            code = NUMBER if kind == "number" else UNIT
        else:
            code = _word_code(form.lower())
            slot = word_slot(code)
            if self.words is not None and not self.words[slot >> 3] >> (slot & 7) & 1:
                code = 0
            if kind == "name":
                code = code | _EITHER if code else NAME
        self[form] = code
        return code


class _Plain(dict):
    """The code of each form, values included."""

    def __missing__(self, form: str) -> int:
        self[form] = code = _word_code(form.lower())
        return code


def _codes(forms: list[str], memory: dict) -> np.ndarray:
    if len(memory) > _REMEMBERED:
        memory.clear()
    return np.fromiter(map(memory.__getitem__, forms), np.int64, len(forms)).astype(np.uint64)


def template_windows(code: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and hash of each whole window with words enough, under each coding of its capitals; and the places of
    windows that have words enough when every capital is a name: those that a copy with other names has too."""
    n = len(code) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    either = code >= _EITHER
    code = np.where(either, code - np.uint64(_EITHER), code)
    used, word = code > 0, code > UNIT
    words, whole, lower = _over(word, n), _over(used, n) == window, _over(word & ~either, n)
    sure = np.flatnonzero(whole & (lower >= LEAST_WORDS))
    at = np.flatnonzero(whole & (words >= LEAST_WORDS))
    h, words = np.zeros(len(at), np.uint64), words[at]
    for j in range(window):
        h = h * np.uint64(_BASE) + code[at + j]
    if either.any():
        change = (np.uint64(NAME) - code) * either
        for j in range(window):
            other = np.flatnonzero(either[at + j] & (words > LEAST_WORDS))
            if len(other):
                move = change[at[other] + j] * np.uint64(pow(_BASE, window - 1 - j, 1 << 64))
                at, h, words = np.concatenate([at, at[other]]), np.concatenate([h, h[other] + move]), np.concatenate([words, words[other] - 1])
    return at, _mixed(h, 0), sure


def _over(flags: np.ndarray, n: int) -> np.ndarray:
    """How many of the flags each of ``n`` windows holds."""
    flags = flags.view(np.int8)
    out = np.zeros(n, np.int8)
    for j in range(len(flags) - n + 1):
        out += flags[j : j + n]
    return out


def plain_windows(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every run of ``size`` tokens."""
    n = max(0, len(code) - size + 1)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * np.uint64(_BASE) + code[j : j + n]
    return np.arange(n), _mixed(h, size)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = h * np.uint64(_BASE) + np.uint64(salt)
    return (h ^ (h >> np.uint64(31))) * _MIX


def word_slot(code: int) -> int:
    return (code >> 4) & ((1 << WORD_BITS) - 1)


def _has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots.astype(np.uint64)
    return (bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


# ---- what is shuffled


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of items: ``kind`` 0 for template windows, else the number of plain tokens in them, -1 for a word of the vocabulary.

    ``forms`` are the values at the placeholders, and at capitals, of a template window; all tokens of a plain one.
    """
    typed, plain = _Typed(), _Plain()
    for batch in batches:
        out = {n: [] for n in (*_HIT_SCHEMA.names, "needed", "length")}
        for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text"))):
            forms = forms_of(text)
            if not forms:
                continue
            low, kinds = [f.lower() for f in forms], [kind_of(f) for f in forms]
            code = _codes(forms, typed)
            at, h, sure = template_windows(code)
            # a share of the windows that renaming leaves; others would count with the names as they are, and not without
            needed, kind = int(np.ceil(SHARE * len(sure))), 0
            counted = np.isin(at, sure)
            at, h = at[counted], h[counted]
            if needed < FEW:
                kind = min(WINDOW, len(forms))
                at, h = plain_windows(_codes(forms, plain), kind)
                needed = len(at)
                values = [low[p : p + kind] for p in at]
            else:
                marked = [f if k != "word" else None for f, k in zip(low, kinds)]
                values = [marked[p : p + WINDOW] for p in at]
                words = np.unique(code[code > UNIT] & np.uint64(_EITHER - 1))
                at, h = np.append(at, np.full(len(words), -1)), np.append(h, words)
                values += [None] * len(words)
            for p, x, v in zip(at.tolist(), h.view(np.int64).tolist(), values):
                for name, value in zip(out, (k1, k2, p, kind if p >= 0 else -1, x, v, needed, len(forms))):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_HIT_SCHEMA.append(pa.field("needed", pa.int32())).append(pa.field("length", pa.int32())))


def _document_batches(shared):
    """Windows of documents that may be windows of items."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, windows, sizes = shared.value
        typed, plain, shift = _Typed(words.tobytes()), _Plain(), np.uint64(64 - WINDOW_BITS)

        def look_up(keys: list[tuple[int, int]], ends: list[int], forms: list[str]) -> pa.RecordBatch | None:
            """Texts laid end to end, so that arrays are long; windows across two of them do not count."""
            cut = [(0, WINDOW, *template_windows(_codes(forms, typed))[:2])]
            if sizes:
                code = _codes(forms, plain)
                cut += [(size, size, *plain_windows(code, size)) for size in sizes]
            stop, start, parts = np.array(ends), np.array([0, *ends[:-1]]), []
            for kind, size, at, h in cut:
                likely = _has(windows, h >> shift)
                at, h = at[likely], h[likely]
                of = np.searchsorted(stop, at, "right")
                inside = at + size <= stop[of]
                parts.append((at[inside], h[inside], of[inside], np.full(int(inside.sum()), kind, np.int32), np.full(int(inside.sum()), size)))
            at, h, of, kind, size = (np.concatenate(c) for c in zip(*parts))
            if not len(at):
                return None
            key = np.array(keys, np.int64)[of]
            values = [[f.lower() for f in forms[p : p + n]] for p, n in zip(at.tolist(), size.tolist())]
            return pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array((at - start[of]).astype(np.int32)), pa.array(kind), pa.array(h.view(np.int64)), pa.array(values, pa.list_(pa.string()))], schema=_HIT_SCHEMA)

        for batch in batches:
            keys, ends, forms = [], [], []
            for k1, k2, text in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text")):
                found = forms_of(text.as_py())
                if found:
                    forms += found
                    keys.append((k1, k2))
                    ends.append(len(forms))
                if len(forms) > _TOGETHER:
                    if (out := look_up(keys, ends, forms)) is not None:
                        yield out
                    keys, ends, forms = [], [], []
            if forms and (out := look_up(keys, ends, forms)) is not None:
                yield out

    return hits


def _bits(slots: Column, rows: DataFrame, size: int) -> np.ndarray:
    """A map of ``2**size`` bits with those of ``slots`` set; what reaches the driver is bounded by it, whatever the rows."""
    words = rows.select(slots.alias("s")).select(F.shiftright("s", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (size - 6), np.uint64)
    out[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return out


# ---- slots


def consistent(region: list[tuple], shift: int) -> int:
    """How many windows of an item agree on what its values stand for, where its copy begins ``shift`` tokens into the text.

    ``region`` holds ``(place in text, place in item, forms in text, values in item)``. Windows in step vote
    on each value; those that the votes bear out count, and then others, the nearest to that step first.
    """
    pairs = {id(h): [(a, b) for a, b in zip(h[3], h[2]) if a is not None] for h in region}
    votes = Counter(pair for h in region if h[0] - h[1] == shift for pair in set(pairs[id(h)]))
    there, back = {}, {}
    for (a, b), _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
        if a not in there and b not in back:
            there[a], back[b] = b, a
    places = set()
    for h in sorted(region, key=lambda h: (abs(h[0] - h[1] - shift), h[0], h[1])):
        mine = pairs[id(h)]
        if all(there.get(a, b) == b and back.get(b, a) == a for a, b in mine) and len(set(mine)) == len({a for a, _ in mine}) == len({b for _, b in mine}):
            there.update(mine)
            back.update((b, a) for a, b in mine)
            places.add(h[1])
    return len(places)


def held_windows(hits: list[tuple], kind: int, needed: int, length: int) -> int:
    """The number of an item's windows that a text holds together; 0 if it does not hold the item."""
    if kind:
        steps = defaultdict(set)
        for p, q, forms, values in hits:
            if forms == values:
                steps[p - q].add(q)
        return needed if any(len(s) == needed for s in steps.values()) else 0
    hits = sorted({(p, q): (p, q, forms, values) for p, q, forms, values in hits}.values(), key=lambda h: h[:2])
    best, first, reach = 0, 0, 2 * length
    for last in range(len(hits)):
        while hits[last][0] - hits[first][0] > reach:
            first += 1
        if last + 1 < len(hits) and hits[last + 1][0] - hits[first][0] <= reach:
            continue
        region = hits[first : last + 1]
        if len({h[1] for h in region}) < needed:
            continue
        for shift, _ in sorted(Counter(h[0] - h[1] for h in region).items(), key=lambda x: (-x[1], x[0])):
            best = max(best, consistent(region, shift))
            if best >= needed:
                break
    return best if best >= needed else 0


def _judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            held_windows([(h["p"], h["q"], h["forms"], h["values"]) for h in hits.as_py()], kind.as_py(), needed.as_py(), length.as_py())
            for hits, kind, needed, length in zip(*(batch.column(c) for c in ("hits", "kind", "needed", "length")))
        ]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k1", "k2", "t1", "t2")), pa.array(found, pa.int32())], names=["k1", "k2", "t1", "t2", "windows"])


# ---- the operator


def _keys(text: Column) -> list[Column]:
    """Two independent hashes that stand for a text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """``(k1, k2, t1, t2, windows)``: texts of documents and of items, by their hashes, that the former hold."""
    spark = docs.sparkSession
    keyed = lambda df, c: df.where(F.col(c).isNotNull() & (F.col(c) != "")).select(*(k.alias(n) for k, n in zip(_keys(F.col(c)), ("k1", "k2"))), F.col(c).alias("text"))
    items = keyed(benchmark, item_text).groupBy("k1", "k2").agg(F.min("text").alias("text"))
    cut = materialize(items.mapInArrow(_item_batches, f"{_HIT}, needed int, length int"), "leak-items")
    windows = cut.where("kind >= 0").select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), F.col("at").alias("q"), "kind", "hash", F.col("forms").alias("values"), "needed", "length").drop_duplicates(["t1", "t2", "q", "kind", "hash"])
    sizes = sorted(r["kind"] for r in cut.where("kind > 0").select("kind").distinct().collect())
    word_bits = _bits(F.shiftright("hash", 4).bitwiseAND(F.lit((1 << WORD_BITS) - 1)), cut.where("kind = -1"), WORD_BITS)
    window_bits = _bits(F.shiftrightunsigned("hash", 64 - WINDOW_BITS), cut.where("kind >= 0"), WINDOW_BITS)
    shared = spark.sparkContext.broadcast((word_bits, window_bits, sizes))
    hits = keyed(docs, text).mapInArrow(_document_batches(shared), _HIT)
    hits = materialize(hits, "leak-hits").drop_duplicates(["k1", "k2", "at", "kind", "hash"])
    hits = materialize(hits, "leak-distinct-hits")
    often = hits.groupBy("hash").agg(F.count(F.lit(1)).alias("often"))
    places = windows.join(often, "hash", "left").groupBy("t1", "t2", "q").agg(F.sum("often").alias("often"), F.max("needed").alias("needed"))
    of_item = "partition by t1, t2"
    rank, count = F.expr(f"row_number() over ({of_item} order by often nulls first, q)"), F.expr(f"count(1) over ({of_item})")
    rare = places.withColumns({"rank": rank, "places": count}).where("rank <= places - needed + 1 and often is not null").select("t1", "t2", "q")
    probes = materialize(windows.select("t1", "t2", "q", "kind", "hash").join(rare, ["t1", "t2", "q"]).select("t1", "t2", "kind", "hash").distinct(), "leak-probes")
    pairs = materialize(hits.select("k1", "k2", "kind", "hash").join(probes, ["kind", "hash"]).select("k1", "k2", "t1", "t2").distinct(), "leak-pairs")
    met = hits.join(pairs, ["k1", "k2"]).join(windows, ["t1", "t2", "kind", "hash"])
    # the windows of one document that meet one item: bounded by the document
    gathered = met.groupBy("k1", "k2", "t1", "t2").agg(
        F.collect_list(F.struct(F.col("at").alias("p"), "q", "forms", "values")).alias("hits"), F.max("kind").alias("kind"), F.max("needed").alias("needed"), F.max("length").alias("length"), F.count_distinct("q").alias("found")
    )
    judged = gathered.where("found >= needed").drop("found").mapInArrow(_judge_batches, "k1 long, k2 long, t1 long, t2 long, windows int")
    return judged.where("windows > 0")


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "leaks") -> DataFrame:
    """``docs`` with an array of ``(item, windows)`` that each text holds, by item.

    What is found is written; documents are joined to it by plain keys, so they are shuffled only
    where Spark finds it too large to send around.
    """
    out = fresh(docs, out)
    kind = benchmark.schema[item_id].dataType.simpleString()
    ids = benchmark.where(F.col(item_text).isNotNull()).select(*(k.alias(n) for k, n in zip(_keys(F.col(item_text)), ("t1", "t2"))), F.col(item_id).alias("item")).distinct()
    found = materialize(matches(docs, benchmark, text, item_text), "leak-matches")
    found = found.join(ids, ["t1", "t2"]).groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("item", "windows"))).alias("found"))
    found = materialize(found, "leaks")
    key = [F.coalesce(k, F.lit(0)).alias(n) for k, n in zip(_keys(F.col(text)), ("_k1", "_k2"))]
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("_row"), *key)
    joined = rows.join(found, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left")
    empty = F.array().cast(f"array<struct<item:{kind},windows:int>>")
    return joined.select(*(F.col("_row")[c].alias(c) for c in docs.columns), F.coalesce("found", empty).alias(out))
