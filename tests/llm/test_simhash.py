import random

import numpy as np
import pytest
import xxhash

from silverlode.llm import simhash
from silverlode.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, root string, fp string"


def brute(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = [w for w in __import__("re").split(rb"[ \t-\r]+", words) if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n", "one", "one two", "One TWO three", "a b c a b c a b c", "Ärger ÄB x y z", "a\x0bb\x0cc\x1fd e", "w " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == brute(text)


def test_fingerprint_of_a_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "_CHUNK", 50)
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefé", k=rng.randint(1, 30))) for _ in range(400))
    assert simhash.fingerprint(text.encode()) == brute(text)


def clusters(rng, n, centers):
    out = []
    for _ in range(n):
        x = rng.choice(centers)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randint(0, 63)
        out.append(x)
    return sorted(set(out))


def closure(fps):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_bit_sliced_comparison_is_exact():
    rng = random.Random(5)
    fps = np.array(clusters(rng, 300, [rng.getrandbits(64) for _ in range(9)]), np.uint64)
    closed = np.zeros((len(fps), -(-len(fps) // 64)), np.uint64)
    a, b = simhash.within_radius(fps, simhash.slices(fps), closed)
    got = {(int(i), int(j)) for i, j in zip(a, b) if j < len(fps)}
    assert got == {(i, j) for i in range(len(fps)) for j in range(len(fps)) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= 3}


@pytest.mark.parametrize("n", [2, 63, 700, 1400])
def test_groups_link_within_themselves_only(n):
    rng = random.Random(n)
    fps = clusters(rng, n, [rng.getrandbits(64) for _ in range(4)])
    double = np.array(fps + fps, np.uint64)
    roots = simhash.link_groups(double, np.array([0, len(fps)]))
    want = closure(fps)
    assert list(roots[: len(fps)]) == want and list(roots[len(fps) :]) == [w + len(fps) for w in want]


def test_any_two_links_share_a_key():
    rng = random.Random(3)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        keys = [(m, subs) for m, subs in simhash._keys() if (a ^ b) & (m & (1 << 64) - 1) == 0]
        assert keys
        for _, subs in keys:
            assert any((a ^ b) & (s & (1 << 64) - 1) == 0 for s in subs)


@pytest.mark.parametrize("hot", [3, 25, 8192])
def test_hot_keys_are_divided_without_loss(spark, hot):
    rng = random.Random(11)
    fps = clusters(rng, 260, [rng.getrandbits(64) for _ in range(3)])
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = {r["node"]: r["root"] for r in connected_components(simhash.fingerprint_links(df, hot)).collect()}
    groups = {}
    for x, c in zip(signed, closure(fps)):
        groups.setdefault(c, []).append(x)
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert got == want


def test_components_of_chains_hubs_and_rings(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 180)]
    hub = [(5000, i) for i in range(6000, 6100)]
    ring = [(i, 900 + (i - 900 + 1) % 30) for i in range(900, 930)]
    edges = chain + hub + ring + [(1, 1), (None, 2)] + chain
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(100, 181)} == {100} and {got[i] for i in range(900, 930)} == {900} and {got[i] for i in range(6000, 6100)} == {5000} and 1 not in got and 2 not in got


def test_query_against_brute_force(spark, data):
    from silverlode.llm.queries import op5_simhash

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    fps = [brute(t) for _, t in docs]
    roots = closure(fps)
    least = {}
    for (d, _), c in zip(docs, roots):
        least[c] = min(d, least.get(c, d))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op5_simhash(spark, data).collect()}
    assert got == {d: (f"{f:016x}", least[c]) for (d, _), f, c in zip(docs, fps, roots)}


def test_edge_rows(spark):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (None, " ", "x", "y"), (4, "a b c d", "x", "y"), (4, "a b c d", "x", "y"), (None, "quite another text here", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = simhash.simhash_components(df).collect()
    assert sorted((r["component_id"] for r in found), key=repr) == [1, 1, 1, 4, 4, None]
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect()) == [(1, None), (4, "a b c d")] and kept.count() == 3
    assert simhash.simhash_components(df.limit(0)).count() == 0 and simhash.drop_near_duplicates(df.limit(0)).count() == 0
