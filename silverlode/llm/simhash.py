"""SimHash near-duplicates: whole-text fingerprints, block keys, bit-sliced comparison.

Cases, by definition: a null, empty or blank text has fingerprint zero and links like any other;
texts of one or two words are one shingle; repeated rows share a fingerprint and thus a component;
a null id takes part, but a component's id is its least non-null id (null if there is none);
an empty table gives an empty result; other columns are left alone, whatever their names.
"""

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .store import materialize

SEED = 42
RADIUS = 3
#: Fixed layout of the 64 bits: any two fingerprints within three bits agree on two of these five blocks.
BLOCKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
#: A key with more fingerprints than this is divided by further bits, then into chunks compared pair by pair.
HOT = 8192
TILE = 512
_CHUNK = 1 << 20
_SPACE = re.compile(rb"[ \t-\r]")
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _keys() -> list[tuple[int, list[int]]]:
    """For each of the ten keys: its mask, and the masks of the four parts of the other bits.

    Within a key the other bits differ in three places at most, so two links agree on one of four parts.
    """
    out = []
    for pair in combinations(range(len(BLOCKS)), 2):
        fixed = [b for k in pair for b in range(*BLOCKS[k])]
        rest = [b for b in range(64) if b not in fixed]
        parts = [rest[i::4] for i in range(4)]
        out.append((_mask(fixed), [_mask(fixed + part) for part in parts]))
    return out


def fingerprint(text: bytes | None, width: int = 3, seed: int = SEED) -> int:
    """SimHash of the UTF-8 text, A-Z lower-cased, over word shingles; long texts go through in pieces."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    data = (text or b"").lower()
    ones, total, carry, start = np.zeros(64, np.int64), 0, [], 0
    while start < len(data):
        end = min(len(data), start + _CHUNK)
        if end < len(data):
            gap = _SPACE.search(data, end)
            end = gap.start() if gap else len(data)
        words = carry + data[start:end].split()
        start = end
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
            hashes = np.fromiter(map(digest, shingles, repeat(seed)), np.uint64, len(words) - width + 1)
            ones += _bit_counts(hashes)
            total += len(hashes)
            carry = words[-(width - 1) :] if width > 1 else []
        else:
            carry = words
    if not total:
        if not carry:
            return 0
        total = 1
        ones = _bit_counts(np.array([digest(b" ".join(carry), seed)], np.uint64))
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _fingerprint_udf():
    import pandas as pd

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else None) for t in texts]
        return pd.Series(np.array(values, np.uint64).astype(np.int64), dtype="int64")

    return fingerprints


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``df`` and its 64-bit fingerprint as a signed long."""
    return df.withColumn(out, _fingerprint_udf()(F.col(text)))


def hex_fingerprint(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


# ---- comparison


def slices(fps: np.ndarray) -> np.ndarray:
    """Bit planes, stored vertically: row b holds bit b of every fingerprint, 64 of them to a word."""
    lanes = -(-len(fps) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within_radius(queries: np.ndarray, planes: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, lane) at three or fewer differing bits, for lanes open in ``closed`` (a word of lanes a column).

    Two carry-save planes count the differences of 64 lanes at once and a third holds those beyond
    the radius for good; every eighth plane, queries with no lane left are abandoned.
    """
    alive = np.arange(len(queries))
    over, low, high = closed.copy(), np.zeros_like(closed), np.zeros_like(closed)
    for b in range(64):
        sign = np.where((queries[alive] >> np.uint64(b)) & np.uint64(1), _FULL, np.uint64(0))
        x = planes[b][None, :] ^ sign[:, None]
        carry = low & x
        low ^= x
        over |= high & carry
        high ^= carry
        if b % 8 == 7:
            keep = (over != _FULL).any(axis=1)
            if not keep.all():
                alive, over, low, high = alive[keep], over[keep], low[keep], high[keep]
                if not len(alive):
                    return alive, alive
    bits = np.unpackbits((~over).view(np.uint8).reshape(len(alive), -1), axis=1, bitorder="little")
    q, lane = np.nonzero(bits)
    return alive[q], lane


class _Forest:
    """Union-find over positions, joined by arrays of pairs."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        out = self.up[at]
        while True:
            above = self.up[out]
            if (above == out).all():
                return out
            out = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def link_groups(fps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For fingerprints laid out in groups that begin at ``starts``: the position of each one's root within its group."""
    ends = np.append(starts[1:], len(fps))
    forest = _Forest(len(fps))
    of = np.repeat(np.arange(len(starts)), ends - starts)
    at = 0
    while at < len(starts):
        first = starts[at]
        last = max(at + 1, int(np.searchsorted(ends, first + TILE, side="right")))
        stop = ends[last - 1]
        for lo in range(first, stop, TILE):
            planes, lanes = slices(fps[lo : min(lo + TILE, stop)]), np.arange(lo, min(lo + TILE, stop))
            for q in range(first, lo + 1, TILE):
                rows = np.arange(q, min(q + TILE, stop))
                open_ = (of[rows][:, None] == of[lanes][None, :]) & (rows[:, None] < lanes[None, :])
                padded = np.zeros((len(rows), planes.shape[1] * 64), bool)
                padded[:, : len(lanes)] = open_
                closed = ~np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
                a, b = within_radius(fps[rows], planes, closed)
                forest.join(rows[a], lanes[b])
        at = last
    return forest.roots(np.arange(len(fps)))


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group may span batches. Yields a star of edges for each linked set."""
    cols = ("t", "key", "part", "fp")
    held = {c: np.empty(0, np.int64) for c in cols}

    def stars(block: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        n = len(block["fp"])
        if n < 2:
            return None
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([block[c][1:] != block[c][:-1] for c in cols[:3]])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        rows = np.repeat(sizes > 1, sizes)
        if not rows.any():
            return None
        fps, sizes = block["fp"][rows], sizes[sizes > 1]
        roots = link_groups(fps.view(np.uint64), np.append(0, np.cumsum(sizes)[:-1]))
        child = np.flatnonzero(roots != np.arange(len(fps)))
        if not len(child):
            return None
        edges = np.unique(np.stack([fps[child], fps[roots[child]]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    for batch in batches:
        for c in cols:
            held[c] = np.append(held[c], batch.column(c).to_numpy(zero_copy_only=False))
        n = len(held["fp"])
        same = np.logical_and.reduce([held[c] == held[c][-1] for c in cols[:3]]) if n else np.zeros(0, bool)
        cut = n - int(same.sum())
        if cut:
            if (out := stars({c: v[:cut] for c, v in held.items()})) is not None:
                yield out
            held = {c: v[cut:] for c, v in held.items()}
    if (out := stars(held)) is not None:
        yield out


def _compare(rows: DataFrame) -> DataFrame:
    dealt = rows.select("t", "key", "part", "fp").repartition("t", "key", "part")
    return dealt.sortWithinPartitions("t", "key", "part", "fp").mapInArrow(_link_batches, "a long, b long")


def _hot(rows: DataFrame, hot: int) -> DataFrame:
    return materialize(rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "simhash-hot")


def fingerprint_links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges ``(a, b)`` that join all of distinct ``fps(fp)`` linked within three bits; stars, not all pairs."""
    keys = _keys()
    rows = fps.select(
        F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, (m, _) in enumerate(keys)))).alias("k"),
        "fp",
    ).select("k.t", "k.key", F.lit(0).cast("long").alias("part"), "fp")
    wide = _hot(rows, hot)
    if wide.isEmpty():
        return _compare(rows)
    parts = F.array(*(F.array(*(F.lit(m) for m in sub)) for _, sub in keys))
    finer = (
        rows.join(wide.select("t", "key"), ["t", "key"], "left_semi")
        .select("t", "fp", F.posexplode(F.element_at(parts, F.col("t").cast("int") + 1)).alias("u", "m"))
        .select((F.lit(100) + F.col("t") * 4 + F.col("u")).alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), F.lit(0).cast("long").alias("part"), "fp")
    )
    finer = materialize(finer, "simhash-finer")
    cold = rows.join(wide.select("t", "key"), ["t", "key"], "left_anti")
    dense = _hot(finer, hot)
    if dense.isEmpty():
        return _compare(cold.unionByName(finer))
    chunks = F.ceil(F.col("n") / hot).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    tiled = (
        finer.drop("part")
        .join(dense, ["t", "key"])
        .select("t", "key", "fp", chunks.alias("c"), own.alias("i"))
        .select("t", "key", "fp", "c", "i", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j"))
        .select("t", "key", (F.least("i", "j").cast("long") * F.col("c") + F.greatest("i", "j")).alias("part"), "fp")
    )
    cool = finer.join(dense.select("t", "key"), ["t", "key"], "left_anti")
    return _compare(cold.unionByName(cool).unionByName(tiled))


def simhash_components(df: DataFrame, id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``df``: ``(id, text_hash, fp, root, component_id, keeper_hash)``.

    ``component_id`` is the least id linked through any chain; ``keeper_hash`` is the text hash of
    the row that stands for the component.
    """
    slim = df.select(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    slim = materialize(with_fingerprint(slim).drop("text"), "simhash-fp")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_hash")))
    reps = materialize(slim.groupBy("fp").agg(best.alias("rep")), "simhash-reps")
    labels = connected_components(fingerprint_links(reps.select("fp"), hot))
    rooted = reps.join(labels, reps["fp"] == labels["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "rep"
    )
    # written first: the join is then plain, so adaptive execution can split a large component
    least = materialize(rooted.groupBy("root").agg(F.min("rep").alias("least")), "simhash-least")
    table = rooted.select("fp", "root").join(least, "root")
    table = materialize(table.select(F.col("fp").alias("_fp"), "root", F.col("least.id").alias("component_id"), F.col("least.text_hash").alias("keeper_hash")), "simhash-table")
    return slim.join(table, slim["fp"] == table["_fp"], "left").drop("_fp")


def drop_near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` that stand for their component: the least id, and one row of it, stays."""
    found = simhash_components(df, id, text)
    keep = found.where(F.col("id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keeper_hash")))
    zero = F.lit(0).cast(df.schema[id].dataType)
    keep = keep.select(F.col("id").isNull().alias("_n"), F.coalesce("id", zero).alias("_i"), F.col("text_hash").alias("_th")).distinct()
    # the row travels as one struct, so no name of its columns can clash
    marked = df.select(F.struct(*df.columns).alias("row"), F.col(id).isNull().alias("_n"), F.coalesce(F.col(id), zero).alias("_i"), F.xxhash64(F.col(text)).alias("_th"))
    kept = marked.join(keep, ["_n", "_i", "_th"], "left_semi")
    order = Window.partitionBy("_n", "_i", "_th").orderBy("_th")
    return kept.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").select(*(F.col("row")[c].alias(c) for c in df.columns))
