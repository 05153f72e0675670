"""Commits that survive a crash after any step, the key index, and what a load reports."""

import datetime as dt
import os

import pytest

from voltaic.operators import keyindex
from voltaic.sources import files, redo, tables

BASE = dt.datetime(2024, 1, 1)
S = "k long, ts timestamp_ntz, v double, _ingested_at timestamp_ntz"


def _df(spark, rows):
    return spark.createDataFrame(rows, S)


def _rows(keys, months, v, day):
    """Key k in month k % months, ingested on ``day``."""
    return [(k, dt.datetime(2023 + (k % months) // 12, (k % months) % 12 + 1, 3), v + k, BASE + dt.timedelta(days=day)) for k in keys]


def _stored(spark, path):
    return sorted(map(tuple, tables.read_table(spark, path).select("k", "ts", "v", "year", "month").collect()))


class Crash(Exception):
    pass


def _crash_at(monkeypatch, n):
    """Raise at the n-th step from now; returns the steps seen."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == n:
            raise Crash(name)
    monkeypatch.setattr(redo, "_step", step)
    return seen


@pytest.mark.parametrize("movable", [True, False])
def test_a_crash_after_any_step(spark, scratch, monkeypatch, movable):
    if not movable:  # as on an object store, where moving is copying
        monkeypatch.setattr(files, "can_move", lambda *a: False)
    first, second = _rows(range(12), 4, 0.0, 0), _rows(range(6, 15), 4, 100.0, 1)
    # key 7 moves from April to a month of its own; key 3 leaves April, which is then empty
    second += [(3, dt.datetime(2024, 5, 1), 1.0, BASE + dt.timedelta(days=1)), (11, dt.datetime(2024, 6, 1), 2.0, BASE + dt.timedelta(days=2))]
    load = lambda path, rows: tables.upsert_table(spark, path, _df(spark, rows), ["k"], time_col="ts")
    plain = scratch("plain")
    load(plain, first)
    load(plain, second)
    want, n, steps = _stored(spark, plain), 1, []
    while True:
        path = scratch("crash")
        load(path, first)
        with monkeypatch.context() as m:
            seen = _crash_at(m, n)
            try:
                load(path, second)
                done = True
            except Crash:
                done = False
        if done:
            break
        steps = seen
        changed = redo.pending(spark, path)[0]
        redo.recover(spark, path)
        if steps[-1] == "staged":  # nothing was promised yet
            load(path, second)
        assert _stored(spark, path) == want, steps[-1]
        assert files.list_names(spark, files.log_dir(path, "redo")) == []
        assert changed is not None and redo.pending(spark, path)[0] >= changed
        n += 1 if n < 4 else 2
    assert {"intent", "recorded", "partition" if movable else "written"} <= set(steps) and n > 5


def test_the_next_load_recovers(spark, scratch, monkeypatch):
    path = scratch("next")
    tables.upsert_table(spark, path, _df(spark, _rows(range(8), 3, 0.0, 0)), ["k"], time_col="ts")
    with monkeypatch.context() as m:
        _crash_at(m, 3)
        with pytest.raises(Crash):
            tables.upsert_table(spark, path, _df(spark, _rows(range(4), 3, 10.0, 1)), ["k"], time_col="ts")
    out = tables.upsert_table(spark, path, _df(spark, _rows([20], 3, 0.0, 2)), ["k"], time_col="ts", counts=True)
    assert out["inserted"] == 1 and out["updated"] == 0
    assert {k: v for k, _, v, _, _ in _stored(spark, path)} == {**{k: 10.0 + k for k in range(4)}, **{k: float(k) for k in range(4, 8)}, 20: 20.0}


def test_counts(spark, scratch):
    path = scratch("counts")
    first = _rows(range(20), 5, 0.0, 0)
    out = tables.upsert_table(spark, path, _df(spark, first + first[:3]), ["k"], time_col="ts", counts=True)
    assert (out["rows_in"], out["rows"], out["inserted"], out["updated"]) == (23, 20, 20, 0) and len(out["changed"]) == 5
    again = _rows(range(5), 5, 0.0, 1) + _rows(range(5, 8), 5, 9.0, 1) + _rows(range(30, 32), 5, 0.0, 1) + _rows([30], 5, 1.0, 2)
    out = tables.upsert_table(spark, path, _df(spark, again), ["k"], time_col="ts", counts=True)
    assert (out["rows_in"], out["rows"], out["inserted"], out["updated"], out["unchanged"]) == (11, 10, 2, 3, 5)
    assert tables.upsert_table(spark, path, _df(spark, []), ["k"], time_col="ts", counts=True)["action"] == "none"
    # null values and keys: equal nulls are unchanged
    odd = [(None, BASE, None, BASE), (50, BASE, None, BASE)]
    tables.upsert_table(spark, path, _df(spark, odd), ["k"], time_col="ts")
    out = tables.upsert_table(spark, path, _df(spark, odd), ["k"], time_col="ts", counts=True)
    assert (out["inserted"], out["updated"], out["unchanged"]) == (0, 0, 2)


def test_only_candidate_partitions_are_searched(spark, scratch, monkeypatch):
    """Two years of months, a load into one of them: the filters leave nothing else to search."""
    path, searched = scratch("indexed"), []
    tables.upsert_table(spark, path, _df(spark, _rows(range(2400), 24, 0.0, 0)), ["k"], time_col="ts")
    plain = tables._read_partitions

    def read(spark, where, parts, values, like):
        if where == path:
            searched.append(sorted(values))
        return plain(spark, where, parts, values, like)
    monkeypatch.setattr(tables, "_read_partitions", read)
    new = [(5000 + i, dt.datetime(2024, 12, 5), 1.0, BASE + dt.timedelta(days=9)) for i in range(50)]
    tables.upsert_table(spark, path, _df(spark, new), ["k"], time_col="ts")
    assert sorted({p for s in searched for p in s}) == [(2024, 12)]
    searched.clear()
    # a key of March 2023 comes back in December 2024: March is searched, found and rewritten
    moved = [(26, dt.datetime(2024, 12, 6), 7.0, BASE + dt.timedelta(days=10))]
    out = tables.upsert_table(spark, path, _df(spark, moved), ["k"], time_col="ts")
    assert out["partitions"] == 2 and {p for s in searched for p in s} <= {(2023, 3), (2024, 12)}
    rows = _stored(spark, path)
    assert [r for r in rows if r[0] == 26] == [(26, dt.datetime(2024, 12, 6), 7.0, 2024, 12)] and len(rows) == 2450


def test_a_stale_or_lost_index_costs_time_only(spark, scratch):
    path = scratch("stale")
    tables.upsert_table(spark, path, _df(spark, _rows(range(40), 6, 0.0, 0)), ["k"], time_col="ts")
    # rows the index doesn't know come in by another way
    tables.write_partitioned(tables.with_date_parts(_df(spark, [(900, dt.datetime(2023, 2, 1), 1.0, BASE)]), "ts", ("year", "month")), path,
                             ("year", "month"), "append")
    move = lambda k: tables.upsert_table(spark, path, _df(spark, [(k, dt.datetime(2023, 6, 1), 5.0, BASE + dt.timedelta(days=k))]), ["k"], time_col="ts")
    move(900)
    assert [r[3:] for r in _stored(spark, path) if r[0] == 900] == [(2023, 6)]
    files.delete(spark, files.log_dir(path, "keys"))
    move(7)
    assert [r[3:] for r in _stored(spark, path) if r[0] == 7] == [(2023, 6)]
    assert os.path.isdir(files.log_dir(path, "keys"))


def test_filters_hold_every_key(spark):
    rows = spark.range(50_000).selectExpr("id AS a", "CASE WHEN id % 97 <> 0 THEN concat('s', id % 1000) END AS b", "CAST(id % 5 AS INT) AS part")
    filters = keyindex.build(rows, ["a", "b"], ["part"]).cache()
    assert {r["buckets"] for r in filters.select("buckets").distinct().collect()} == {16}
    one = rows.where("part = 3 AND a < 20000").select("a", "b")
    assert (3,) in {tuple(r) for r in keyindex.candidates(filters, one, ["a", "b"], ["part"]).collect()}
    alone = spark.createDataFrame(one.where("b IS NULL").limit(1).collect(), "a long, b string")
    assert (3,) in {tuple(r) for r in keyindex.candidates(filters, alone, ["a", "b"], ["part"]).collect()}
    strangers = spark.range(10_000_000, 10_020_000).selectExpr("id AS a", "'q' AS b")
    assert keyindex.candidates(filters, strangers, ["a", "b"], ["part"]).count() == 0


def test_restore(spark, scratch):
    path = scratch("table")
    tables.upsert_table(spark, path, _df(spark, _rows(range(12), 4, 0.0, 0)), ["k"], time_col="ts")
    before, saved = _stored(spark, path), tables.backup(spark, path, parts=("year", "month"))
    tables.upsert_table(spark, path, _df(spark, _rows(range(3), 4, 50.0, 1)), ["k"], time_col="ts")
    assert _stored(spark, path) != before
    tables.restore(spark, saved, path, ("year", "month"))
    assert _stored(spark, path) == before
    # what a dedupe saved of the partitions it rewrote
    extra = tables.with_date_parts(_df(spark, _rows([1, 5], 4, 0.0, 3)), "ts", ("year", "month"))
    tables.write_partitioned(extra, path, ("year", "month"), "append")
    doubled = _stored(spark, path)
    out = tables.dedupe_table(spark, path, ["k"], parts=("year", "month"))
    assert out["removed"] == 2 and _stored(spark, path) == before
    tables.restore(spark, out["backup"], path, ("year", "month"), whole=False)
    assert _stored(spark, path) == doubled


def test_keys_are_dealt_out_before_their_bits(spark):
    """A key becomes a row for each of its bits, which are sorted: not where the rows happen to lie."""
    rows = spark.range(5000, numPartitions=1).selectExpr("id AS a", "CAST(id % 2 AS INT) AS part")
    filters = keyindex.build(rows, ["a"], ["part"])
    plan = filters._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression" if "RepartitionByExpression" in plan else "REPARTITION_BY_NUM")
    assert filters.count() == 2 * 4
    asked = rows.where("a < 10").select("a")
    assert keyindex.candidates(filters, asked, ["a"], ["part"]).count() == 2


def _dealt(filters):
    """Tasks that keys are dealt to, and rows of the key index's bits."""
    filters.collect()
    plan, found = filters._jdf.queryExecution().executedPlan(), {}

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Generate":
            found["bits"] = node.metrics().apply("numOutputRows").value()
        if name == "Exchange" and "REPARTITION_BY_NUM" in node.toString():
            found["tasks"] = node.outputPartitioning().numPartitions()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found


def test_key_index_tasks_grow_with_keys(spark, monkeypatch):
    """However few shuffle partitions there are, a task sorts the bits of a bounded number of keys."""
    rows = spark.range(5000, numPartitions=2).selectExpr("id AS a", "CAST(id % 2 AS INT) AS part")
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _dealt(keyindex.build(rows, ["a"], ["part"])) == {"tasks": few, "bits": 5000 * keyindex.PROBES}
    monkeypatch.setattr(keyindex, "TASK_KEYS", 100)
    assert few < 50 and _dealt(keyindex.build(rows, ["a"], ["part"])) == {"tasks": 50, "bits": 5000 * keyindex.PROBES}


def test_a_key_of_many_rows_sets_its_bits_once(spark):
    rows = spark.range(4000, numPartitions=2).selectExpr("IF(id < 3000, NULL, id) AS a", "CAST(id % 2 AS INT) AS part")
    filters = keyindex.build(rows, ["a"], ["part"])
    assert _dealt(filters)["bits"] == (1000 + 2) * keyindex.PROBES
    for asked in ("CAST(NULL AS BIGINT) AS a", "3001L AS a"):
        assert keyindex.candidates(filters, spark.range(1).selectExpr(asked), ["a"], ["part"]).count() >= 1
