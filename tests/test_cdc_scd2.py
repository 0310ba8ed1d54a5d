import itertools
import random

import pytest

from silverlode.operators import cdc, scd2
from silverlode.plans.config import ConfigError

SPEC = cdc.CdcSpec(("cid",), ("ts", "seq"), "op")
SCHEMA = "op string, cid bigint, tier string, ts string, seq bigint"
HIST = ["cid"], ["ts", "seq"], ["tier"]


def events(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def out(df):
    return sorted(((r["_op"], r["cid"], r["tier"], r["ts"], r["seq"]) for r in df.collect()), key=repr)


def test_replays_conflicts_orphans(spark):
    n = cdc.normalize(events(
        spark, ("I", 1, "A", "t1", 1), ("U", 1, "A", "t1", 1), ("U", 1, "B", "t2", 1), ("U", 1, "C", "t2", 1), ("D", 1, None, "t2", 1), ("D", 2, None, "t1", 1), ("D", 1, None, "t3", 1), ("?", 3, "X", "t1", None),
    ), SPEC)
    assert out(n.applied) == sorted([("U", 1, "A", "t1", 1), ("U", 1, "C", "t2", 1), ("D", 1, None, "t3", 1), ("U", 3, "X", "t1", None)], key=repr)
    assert out(n.conflicts) == sorted([("U", 1, "B", "t2", 1), ("D", 1, None, "t2", 1)], key=repr)
    assert out(n.held_orphans) == [("D", 2, None, "t1", 1)]
    assert n.replays.first()[0] == 1


def test_known_keys_release_orphans(spark):
    n = cdc.normalize(events(spark, ("D", 2, None, "t1", 1), ("D", 9, None, "t1", 1)), SPEC, spark.createDataFrame([(2,), (2,)], "cid bigint"))
    assert out(n.applied) == [("D", 2, None, "t1", 1)] and out(n.held_orphans) == [("D", 9, None, "t1", 1)]


def test_normalize_accounts_for_every_event(spark):
    rng = random.Random(7)
    rows = [(rng.choice("UID"), rng.randint(1, 4), rng.choice(["A", "B", None]), f"t{rng.randint(1, 3)}", rng.choice([1, 2, None])) for _ in range(120)]
    n = cdc.normalize(events(spark, *rows), SPEC)
    assert n.applied.count() + n.held_orphans.count() + n.conflicts.count() + n.replays.first()[0] == len(rows)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_share_one_exchange_behind_merged_copies(spark):
    applied = cdc.normalize(events(spark, ("U", 1, "A", "t", 1)), SPEC).applied
    for df in (applied, scd2.rebuild(events(spark, ("U", 1, "A", "t", 1)).withColumnRenamed("op", "_op"), *HIST)):
        plan = planned(df)
        assert plan.count("Exchange ") == 2 and plan.count("REPARTITION_BY_COL") == 1
        assert "Aggregate(" in plan[plan.rindex("Exchange ") :], "copies are merged before the first shuffle"


@pytest.mark.parametrize("copies", [1, 4000])
def test_copies_of_one_event_are_few_rows_when_shuffled(spark, copies):
    story = [("U", 1, "A", "t1", 1), ("U", 1, "B", "t2", 1), ("D", 1, None, "t2", 1), ("U", 1, "C", "t2", 1), ("D", 1, None, "t3", 1)]
    n = cdc.normalize(events(spark, *story * copies), SPEC)
    assert out(n.applied) == sorted([("U", 1, "A", "t1", 1), ("U", 1, "C", "t2", 1), ("D", 1, None, "t3", 1)], key=repr)
    assert n.conflicts.count() == 2 and n.held_orphans.isEmpty() and n.replays.first()[0] == 5 * (copies - 1)
    h = scd2.rebuild(events(spark, *story * copies).withColumnRenamed("op", "_op"), *HIST)
    assert [(r["tier"], r["is_deleted"]) for r in h.orderBy("ts").collect()] == [("A", False), ("C", False), (None, True)]


def test_the_first_copy_is_the_one_kept(spark):
    spec = cdc.CdcSpec(("cid",), ("ts",), "op")
    rows = spark.createDataFrame([("U", 1, "A", "t1", "f2#1", "f2"), ("U", 1, "A", "t1", "f1#9", "f1"), ("U", 1, "A", "t1", None, "f3")], "op string, cid bigint, tier string, ts string, _ingestion_order string, _source_file string")
    kept = cdc.normalize(rows, spec).applied
    assert kept.columns == ["cid", "tier", "ts", "_ingestion_order", "_source_file", "_op"]
    assert [(r["_ingestion_order"], r["_source_file"]) for r in kept.collect()] == [(None, "f3")]
    assert [r["_ingestion_order"] for r in cdc.normalize(rows.where("_ingestion_order is not null"), spec).applied.collect()] == ["f1#9"]
    assert cdc.normalize(rows.limit(0), spec).replays.first()[0] == 0


def test_unify_refuses_other_columns(spark):
    a, b = spark.range(1), spark.range(1).withColumnRenamed("id", "x")
    with pytest.raises(ConfigError):
        cdc.unify(a, b)


def chain(spark, *rows):
    return cdc.normalize(events(spark, *rows), SPEC).applied


def versions(history):
    rows = history.collect()
    return sorted(((r["cid"], r["ts"], r["seq"], r["tier"], r["is_deleted"], r["_to_ts"], r["_is_terminal"], r["is_current"]) for r in rows), key=repr)


def test_history_story(spark):
    h = scd2.rebuild(chain(spark, ("U", 1, "A", "t1", 1), ("U", 1, "A", "t2", 1), ("U", 1, "B", "t3", 1), ("D", 1, None, "t4", 1), ("U", 1, "B", "t5", 1)), *HIST)
    assert versions(h) == [(1, "t1", 1, "A", False, "t3", False, False), (1, "t3", 1, "B", False, "t4", False, False), (1, "t4", 1, None, True, "t5", False, False), (1, "t5", 1, "B", False, None, True, True)]
    assert scd2.violations(h, ["cid"], ["ts", "seq"]).isEmpty()


def test_delete_leaves_no_current(spark):
    h = scd2.rebuild(chain(spark, ("U", 1, "A", "t1", 1), ("D", 1, None, "t2", 1), ("D", 1, None, "t3", 1)), *HIST)
    assert h.count() == 2 and scd2.current(h).isEmpty() and scd2.violations(h, ["cid"], ["ts", "seq"]).isEmpty()


def test_upsert_wins_its_place_across_batches(spark):
    up, down = events(spark, ("U", 1, "A", "t1", 1)), events(spark, ("D", 1, None, "t1", 1))
    known = spark.createDataFrame([(1,)], "cid bigint")
    u, d = cdc.normalize(up, SPEC, known).applied, cdc.normalize(down, SPEC, known).applied
    for a, b in ((u, d), (d, u)):
        h = scd2.rebuild(b, *HIST, history=scd2.rebuild(a, *HIST))
        assert [(r["tier"], r["is_current"]) for r in h.collect()] == [("A", True)]


def test_in_order_batches_equal_one_run(spark):
    rng = random.Random(23)
    rows = sorted({(rng.choice("UUD"), 1 + i % 3, rng.choice("AB"), f"t{i:02d}", 1) for i in range(24)}, key=lambda r: r[3])
    all_events = cdc.normalize(events(spark, *rows), SPEC).applied.cache()
    history = None
    for a, b in itertools.pairwise((0, 8, 16, 24)):
        part = all_events.where(f"ts >= 't{a:02d}' and ts < 't{b:02d}'")
        history = scd2.rebuild(part, *HIST, history=history)
    assert versions(history) == versions(scd2.rebuild(all_events, *HIST))


def test_null_sequence_is_lowest(spark):
    h = scd2.rebuild(chain(spark, ("U", 1, "S", "t1", None), ("U", 1, "E", "t1", 1)), *HIST)
    assert [(r["tier"], r["_is_terminal"]) for r in h.orderBy("_is_terminal").collect()] == [("S", False), ("E", True)]


@pytest.mark.parametrize("change, violation", [("is_current = false", "current_count"), ("_to_ts = 'x'", "gap_or_overlap"), ("_is_terminal = false", "open_tail")])
def test_violations_are_seen(spark, change, violation):
    h = scd2.rebuild(chain(spark, ("U", 1, "A", "t1", 1), ("U", 1, "B", "t2", 1)), *HIST)
    column, value = change.split(" = ")
    broken = h.selectExpr(*(f"{value} as {c}" if c == column else c for c in h.columns))
    assert violation in {r["violation"] for r in scd2.violations(broken, ["cid"], ["ts", "seq"]).collect()}
