"""Embedding near-duplicates by a forest of random-projection trees.

Trees split at the median along random directions; rows near a split go to both sides. The forest is
fitted on a bounded sample, every vector is sent to its leaves, each leaf is compared in blocks in
double precision, and what is linked is united. A pair that shares several leaves counts in the
first of them alone, so numbers of links come from sums and no pair is ever written.

A group of near copies larger than a leaf would be cut by every tree, so balls that hold half a leaf or
more of the sample become cells before the trees are grown: the core of a cell is the rows within one
threshold angle of its centre, and by the triangle inequality all they can link with is within two.
Each core is compared whole with itself and with those rows, exactly; only pairs of rows outside all
cores are left to the forest.

Leaves are made for the rows of the commonest label, as only rows of one label are compared. The sample
bounds how fine the fitted trees can be, so a leaf that holds more rows of a label than a bound is split
again at quantiles of its own rows, round after round, in tables: what is compared together stays
bounded however many rows there are, and nothing that grows reaches the driver. A leaf that no direction
splits is dense, and is compared whole, in blocks.

Cases, by definition: a vector that is null, empty, zero or holds null, NaN or infinite components, or
whose label is null, links with nothing and is its own component; equal vectors of one label are
linked, counted by their number and compared once; repeated ids are rows like others; null ids take
part but name no component unless all of it lacks ids; vectors of different lengths never link; an
empty table gives an empty result; extra columns are left alone.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import materialize

THRESHOLD = 0.93
TREES = 4
#: Rows of one label in a leaf, about; a leaf of more than the second number is split again.
LEAF, MOST = 1024, 8192
SPILL = 0.06
#: Bounds of the sample that the forest is fitted on: rows, and numbers in them.
SAMPLE, SAMPLE_VALUES = 20_000, 4_000_000
LEAST_NODE = 16
#: Lengths of vectors that trees are fitted for; others begin as one leaf, split like any that is too large.
FITTED = 64
#: A leaf of more rows is compared as pairs of blocks of this many.
BLOCK = 4096
#: Rows that are multiplied at once.
STRIP = 512


class Forest:
    """Trees over vectors of one length; leaves are numbered through all trees in order."""

    def __init__(self, sample: np.ndarray, stop: float, trees: int = TREES, spill: float = SPILL, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.leaves, self.spill = 0, spill
        self.trees = [self._grow(sample, np.arange(len(sample)), max(stop, LEAST_NODE), rng) for _ in range(trees)]

    def _grow(self, x, rows, stop, rng):
        if len(rows) > stop:
            way = rng.standard_normal(x.shape[1])
            at = x[rows] @ way
            low, mid, high = np.quantile(at, [0.5 - self.spill, 0.5, 0.5 + self.spill])
            left, right = rows[at <= high], rows[at >= low]
            if len(left) < len(rows) and len(right) < len(rows):
                return (way, low, high, self._grow(x, left, stop, rng), self._grow(x, right, stop, rng))
        self.leaves += 1
        return self.leaves - 1

    def place(self, x: np.ndarray) -> list[list[int]]:
        """The leaves of each row, in increasing order."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        for tree in self.trees:
            stack = [(tree, np.arange(len(x)))]
            while stack:
                node, rows = stack.pop()
                if not len(rows):
                    continue
                if isinstance(node, int):
                    for r in rows:
                        out[r].append(node)
                    continue
                at = x[rows] @ node[0]
                stack += [(node[4], rows[at >= node[1]]), (node[3], rows[at <= node[2]])]
        return [sorted(o) for o in out]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow for large components."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Cells:
    """Dense balls of a sample: no ball about an uncovered row of it holds ``least`` or more uncovered rows."""

    def __init__(self, sample: np.ndarray, least: float, threshold: float):
        angle = np.arccos(np.clip(threshold, -1.0, 1.0))
        self.core, self.reach = threshold, np.cos(min(np.pi, 2 * angle)) - 1e-9
        x = sample.astype(np.float32)
        counts = lambda rows, of: np.concatenate([(x[rows[s : s + STRIP]] @ of.T >= threshold).sum(axis=1) for s in range(0, len(rows), STRIP)] or [np.zeros(0, int)])
        free = np.ones(len(x), bool)
        degree = counts(np.arange(len(x)), x)
        centers = []
        while len(x) and degree[top := int(degree.argmax())] >= least:
            center, ball = sample[top], free & (x @ x[top] >= threshold)
            mean = sample[ball].sum(axis=0)
            mean /= max(np.sqrt(mean @ mean), 1e-300)
            if (wide := free & (sample @ mean >= threshold)).sum() >= ball.sum() and wide[top]:
                center, ball = mean, wide
            ball[top] = True
            centers.append(center)
            free &= ~ball
            degree[ball] = 0
            rest = np.flatnonzero(free & (degree >= least))
            degree[rest] -= counts(rest, x[ball])
        self.centers = np.array(centers).reshape(len(centers), sample.shape[1])
        self.free = free

    def place(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The cell whose core holds each row, or -1; and the cells before it that the row has to be shown to."""
        if not len(self.centers):
            return np.full(len(x), -1), [[] for _ in range(len(x))]
        at = x @ self.centers.T
        home = np.where(at.max(axis=1) >= self.core, at.argmax(axis=1), -1)
        # a pair of two cores is met in the earlier cell alone
        shown = (at >= self.reach) & (np.arange(at.shape[1]) < np.where(home < 0, at.shape[1], home)[:, None])
        return home, [np.flatnonzero(r).tolist() for r in shown]


def compare_leaf(x: np.ndarray, weight: np.ndarray, leaves: list, leaf: int, side: np.ndarray, core: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of links of each row that this leaf is the first to hold, and the position of each one's root.

    ``side`` is 0 where all rows are compared with one another; of rows of sides 1 and 2 only pairs across count.
    Only pairs with a row of ``core`` count.
    """
    n, across = len(x), bool(side.any())
    one, two = (np.flatnonzero(side == 1), np.flatnonzero(side == 2)) if across else (np.arange(n), np.arange(n))
    a, b = x[one], x[two]
    near = np.zeros((len(one), len(two)), bool)
    for s in range(0, len(one), STRIP):
        low = 0 if across else s
        near[s : s + STRIP, low:] = a[s : s + STRIP] @ b[low:].T >= threshold
    if not across:
        near = np.triu(near, 1)
        near |= near.T
    if not core.all():
        near &= core[one][:, None] | core[two][None, :]
    owner = np.repeat(np.arange(n), [len(v) for v in leaves])
    flat = np.concatenate([np.asarray(v, np.int64) for v in leaves])
    early = (flat >= 0) & (flat < leaf)
    fresh = near
    if early.any():
        names, place = np.unique(flat[early], return_inverse=True)
        member = np.zeros((n, len(names)), np.float32)
        member[owner[early], place] = 1
        fresh = near & (member[one] @ member[two].T == 0)
    links = np.zeros(n, np.int64)
    links[one] = fresh @ weight[two]
    if across:
        links[two] = fresh.T @ weight[one]
    root = np.arange(n)
    while True:
        least = root.copy()
        least[one] = np.minimum(root[one], _least(near, root[two]))
        if across:
            least[two] = np.minimum(root[two], _least(near.T, root[one]))
        least = least[least]
        if (least == root).all():
            return links, root
        root = least


def _least(near: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The least of the values that each row is near to."""
    out, none = np.full(len(near), np.iinfo(np.int32).max, np.int64), np.int32(np.iinfo(np.int32).max)
    if near.shape[1]:
        values = values.astype(np.int32)
        for s in range(0, len(near), STRIP):
            out[s : s + STRIP] = np.where(near[s : s + STRIP], values[None, :], none).min(axis=1)
    return out


def _valid(vector: str):
    kind = F.col(vector).cast("array<double>")
    fine = F.forall(kind, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(kind, lambda v: v != 0), F.lit(False))


def _node_key(label: str, vector: str):
    """A hash of label and vector; the label's length goes first, so that no label can run into the numbers."""
    name = F.col(label).cast("string")
    return F.md5(F.concat(F.length(name).cast("string"), F.lit(":"), name, F.lit(":"), F.array_join(F.col(vector).cast("array<string>"), ",")))


def embedding_components(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, leaf: int = LEAF, block: int = BLOCK, sample: int = SAMPLE, most: int = MOST
) -> DataFrame:
    """One row per row of ``df``: ``(id, n_links, component_id)``."""
    key = F.when(_valid(vector) & F.col(label).isNotNull(), _node_key(label, vector))
    # floats travel as floats; they turn into doubles, exactly, where they are compared
    kept = F.col(vector) if df.schema[vector].dataType.simpleString() == "array<float>" else F.col(vector).cast("array<double>")
    rows = df.select(F.col(id).alias("id"), key.alias("node"), F.col(label).cast("string").alias("label"), kept.alias("v"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.any_value("label").alias("label"), F.any_value("v").alias("v"))
    nodes = materialize(nodes, "embedding-nodes")
    found = materialize(_links(nodes, threshold, leaf, block, sample, most), "embedding-links")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    labels = labels.select(F.col("node").alias("_node"), F.col("root"))
    known = nodes.select("node", "least", "n").join(sums, "node", "left").join(labels, F.col("node") == F.col("_node"), "left")
    known = known.select(F.col("node").alias("_n"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("links"), F.coalesce("root", "node").alias("_root"), "least")
    known = materialize(known, "embedding-known")
    # written first: the join is then plain, so adaptive execution can split a large component
    least = materialize(known.groupBy("_root").agg(F.min("least").alias("component_id")), "embedding-least")
    table = materialize(known.join(least, "_root").select("_n", "links", "component_id"), "embedding-table")
    out = rows.select("id", "node").join(table, F.col("node") == F.col("_n"), "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))


def _links(nodes: DataFrame, threshold: float, leaf: int, block: int, sample: int, most: int) -> DataFrame:
    """``(node, links, root)`` of every leaf of every node."""
    spark = nodes.sparkSession
    shape = nodes.groupBy(F.size("v").alias("d"), "label").agg(F.count(F.lit(1)).alias("n")).groupBy("d").agg(F.sum("n").alias("n"), F.max("n").alias("most")).orderBy(F.desc("n"), "d").limit(FITTED).collect()
    forests, base = {}, 0
    for r in shape:
        size = max(1, min(sample, SAMPLE_VALUES // r["d"]))
        drawn = nodes.where(F.size("v") == r["d"]).orderBy(F.xxhash64("node"), "node").select("v").limit(size).collect()
        x = unit(np.array([v["v"] for v in drawn], np.float64))
        stop = max(leaf * len(x) / r["most"], LEAST_NODE)
        # where one leaf holds all, nothing is cut
        cells = Cells(x if len(x) > stop else x[:0], min(stop, leaf * len(x) / r["n"]) / 2, threshold)
        forest = Forest(x[cells.free] if len(cells.centers) else x, stop)
        forests[r["d"]] = (base, cells, forest)
        base += len(cells.centers) + forest.leaves
    shared = spark.sparkContext.broadcast((forests, base))
    placed = nodes.select("node", "n", "label", "v", _place_udf(shared)("v").alias("places"))
    codes = F.transform("places", lambda p: p["leaf"])
    dealt = placed.select("node", "n", "label", "v", codes.alias("leaves"), F.explode("places").alias("p"))
    # a cell that a row is only shown to stands as the complement of its number
    core = F.col("p.leaf") >= 0
    dealt = dealt.select("node", "n", "label", "v", "leaves", F.when(core, F.col("p.leaf")).otherwise(F.bitwise_not("p.leaf")).alias("leaf"), core.alias("core"), F.col("p.tree").alias("tree"))
    dealt = _split_leaves(dealt, most)
    keys = ["leaf", "label", "part"]
    large = dealt.groupBy("leaf", "label").agg(F.count(F.lit(1)).alias("rows"), F.count_if("core").alias("cores"))
    large = materialize(large.where((F.col("rows") > block) | (F.col("cores") == 0)), "embedding-large")
    if large.isEmpty():
        dealt = dealt.withColumns({"part": F.lit(0).cast("long"), "side": F.lit(0)})
    else:
        # core rows fill the first c parts, shown rows the next; each pair of parts with a core meets once
        wide = dealt.join(large, ["leaf", "label"], "left").where("cores is null or cores > 0")
        wide = wide.withColumns({"c": F.coalesce(F.ceil(F.col("cores") / block), F.lit(1)).cast("int"), "s": F.coalesce(F.ceil((F.col("rows") - F.col("cores")) / block), F.lit(0)).cast("int")})
        hash, split = F.xxhash64("node"), F.col("rows").isNotNull()
        wide = wide.withColumn("i", F.when(F.col("core") | ~split, F.pmod(hash, F.col("c"))).otherwise(F.col("c") + F.pmod(hash, F.greatest("s", F.lit(1)))).cast("int"))
        last = F.when(F.col("core"), F.col("c") + F.col("s")).otherwise(F.col("c")) - 1
        wide = wide.withColumn("j", F.explode(F.sequence(F.lit(0), last)))
        part = F.least("i", "j").cast("long") * (F.col("c") + F.col("s")) + F.greatest("i", "j")
        dealt = wide.select("node", "n", "label", "v", "leaves", "leaf", "core", part.alias("part"), F.when(F.col("i") == F.col("j"), 0).when(F.col("i") < F.col("j"), 1).otherwise(2).alias("side"))
    return dealt.groupBy(*keys).applyInPandas(_compare_udf(threshold), "node string, links long, root string")


def _split_leaves(dealt: DataFrame, most: int) -> DataFrame:
    """``dealt`` with every leaf of a tree split until it holds ``most`` rows of a label or no split helps.

    A leaf is cut like a node of a tree, at the quantiles of its rows along a direction that its number
    seeds, rows near the cut on both sides. Numbers of new leaves are hashes beyond all fitted ones.
    """
    of = ["leaf", "label"]
    large = lambda df, size: materialize(df.where("tree").groupBy(*of).agg(F.count(F.lit(1)).alias("rows"), *size).where(F.col("rows") > most), "embedding-oversize")
    over = large(dealt, [F.lit(None).cast("long").alias("before")])
    if over.isEmpty():
        return dealt.drop("tree")
    dealt = dealt.drop("leaves").withColumn("before", F.lit(None).cast("long"))
    while not over.isEmpty():
        # a leaf that kept nine in ten rows of the one it came from is dense
        live = over.where("before is null or rows < 0.9 * before").select(*of, "rows")
        part = dealt.where("tree").join(live, of).withColumn("at", _project_udf()("v", "leaf"))
        cuts = part.groupBy(*of).agg(F.percentile_approx("at", [0.5 - SPILL, 0.5 + SPILL], 10_000).alias("cut")).select(*(F.col(c).alias(f"_{c}") for c in of), "cut")
        sides = F.array(F.when(F.col("at") <= F.col("cut")[1], F.lit(0)), F.when(F.col("at") >= F.col("cut")[0], F.lit(1)))
        cut = part.join(cuts, (F.col("leaf") == F.col("_leaf")) & (F.col("label") == F.col("_label"))).withColumn("side", F.explode(F.array_compact(sides)))
        child = F.xxhash64("leaf", "label", "side").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        cut = cut.select("node", "n", "label", "v", child.alias("leaf"), "core", "tree", F.col("rows").alias("before"))
        dealt = dealt.join(live.select(*of, F.lit(True).alias("tree")), [*of, "tree"], "left_anti").select(*cut.columns).unionByName(cut)
        dealt = materialize(dealt, "embedding-dealt")
        over = large(dealt, [F.max("before").alias("before")]).where("before is null or rows < 0.9 * before")
    code = F.when(F.col("core"), F.col("leaf")).otherwise(F.bitwise_not("leaf"))
    leaves = dealt.groupBy("node").agg(F.sort_array(F.collect_set(code)).alias("leaves"))
    return dealt.join(leaves, "node").select("node", "n", "label", "v", "leaves", "leaf", "core")


def _project_udf():
    import pandas as pd

    @F.pandas_udf("double")
    def project(vectors: pd.Series, leaves: pd.Series) -> pd.Series:
        out = np.empty(len(vectors))
        for leaf in leaves.unique():
            at = np.flatnonzero(leaves.to_numpy() == leaf)
            x = unit(np.stack([vectors.iloc[i] for i in at]).astype(np.float64))
            out[at] = x @ np.random.default_rng(abs(int(leaf))).standard_normal(x.shape[1])
        return pd.Series(out)

    return project


def _place_udf(shared):
    import pandas as pd

    @F.pandas_udf("array<struct<leaf:long,tree:boolean>>")
    def place(vectors: pd.Series) -> pd.Series:
        forests, extra = shared.value
        out = [None] * len(vectors)
        sizes = np.array([len(v) for v in vectors])
        put = lambda cells, leaves: [{"leaf": int(c), "tree": False} for c in cells] + [{"leaf": int(v), "tree": True} for v in leaves]
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            if d not in forests:  # rare lengths begin with one leaf each, beyond all others
                for i in at:
                    out[i] = put([], [extra + int(d)])
                continue
            base, cells, forest = forests[d]
            x = unit(np.stack([vectors.iloc[i] for i in at]).astype(np.float64))
            home, shown = cells.place(x)
            rest = np.flatnonzero(home < 0)
            leaves = dict(zip(rest.tolist(), forest.place(x[rest])))
            for k, (i, h, cut) in enumerate(zip(at, home, shown)):
                out[i] = put([~(base + v) for v in cut] + ([base + h] if h >= 0 else []), [base + len(cells.centers) + v for v in leaves.get(k, ())])
        return pd.Series(out)

    return place


def _compare_udf(threshold: float):
    def compare(frame):
        import pandas as pd

        leaf = int(frame["leaf"].iloc[0])
        links, roots = np.zeros(len(frame), np.int64), frame["node"].to_numpy().copy()
        x = unit(np.stack(frame["v"].to_numpy()).astype(np.float64))
        n, root = compare_leaf(x, frame["n"].to_numpy(np.int64), list(frame["leaves"]), leaf, frame["side"].to_numpy(), frame["core"].to_numpy(bool), threshold)
        links += n
        return pd.DataFrame({"node": frame["node"], "links": links, "root": roots[root]})

    return compare
