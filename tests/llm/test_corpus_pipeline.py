import re

import corpus_pipeline
from plain import targets
from test_simhash import brute, closure


def test_stages(spark, data):
    """Each stage against a plain version over the same input."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, data), "test-stage")
        steps.append(docs)
    assert all(s.columns == columns for s in steps[:-1]) and steps[-1].columns == [*columns, "shard", "slot"]
    rows = [[tuple(r) for r in s.collect()] for s in steps]

    clean = rows[0]
    roots = closure([brute(r[1]) for r in clean])
    least = {}
    for r, c in zip(clean, roots):
        least[c] = min(r[0], least.get(c, r[0]))
    assert sorted(r[0] for r in rows[1]) == sorted(least.values())

    # plainly: the share of an item's runs of five words that a document has, all or nearly none in these tables
    runs = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 4)}
    items = [runs(r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    leaked = {r[0] for r in rows[1] if any(len(i & runs(r[1])) >= 0.8 * len(i) for i in items)}
    assert leaked and sorted(r[0] for r in rows[2]) == sorted(r[0] for r in rows[1] if r[0] not in leaked)

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = {}, {}
    for r in rows[2]:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    for r in rows[3]:
        taken[r[3]] = taken.get(r[3], 0) + size(r[1])
    goal = dict(zip(sorted(sizes), targets([sizes[s] for s in sorted(sizes)])))
    least = {s: min(size(r[1]) for r in rows[2] if r[3] == s and size(r[1])) for s in sizes}
    assert all(abs(taken.get(s, 0) - goal[s]) <= 0.02 * goal[s] + least[s] for s in sizes), {s: (goal[s], taken.get(s, 0), least[s]) for s in sizes}  # no nearer than its smallest document, where there are few
    assert {r[0] for r in rows[3]} <= {r[0] for r in rows[2]}

    assert sorted(r[:5] for r in rows[4]) == sorted(rows[3])
    for s in range(16):
        slots = sorted(r[6] for r in rows[4] if r[5] == s)
        assert slots == list(range(len(slots)))


def test_columns_of_any_name_pass_through(spark, data):
    """Names that stages use inside, in other cases too; nulls, empty texts and repeated rows beside them."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 60")
    odd = docs.where("doc_id < 3").select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", F.lit(None).cast("string").alias("source"), "n_chars")
    docs = docs.unionByName(docs.where("doc_id < 5")).unionByName(odd)
    mine = ["shard", "Slot", "_size", "_SIZE_", "_copies", "_taken", "pii", "leaks", "LEAKS_", "_host", "_row", "_k1", "k1", "toxicity", "row", "_th", "fp", "_h"]
    docs = docs.select("*", *(F.lit(f"my {n}").alias(n) for n in mine))
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialize(stage(spark, out, data), "clash-stage")
        assert out.columns[: len(docs.columns)] == docs.columns, name
    assert out.columns[len(docs.columns) :] == ["shard_", "slot_"] and out.count() > 10
    assert {tuple(r[n] for n in mine) for r in out.collect()} == {tuple(f"my {n}" for n in mine)}


def test_empty_corpus(spark, data, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{data}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
