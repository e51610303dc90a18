import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneflow.operators import panes as panes_module
from paneflow.operators.carry import carried_batches, ended_windows, held_batches
from paneflow.operators.panes import panes, panes_by_count
from paneflow.operators.windows import (
    NUMBER_BLOCK,
    batch_sizes,
    batch_summary,
    count_batches,
    duration_micros,
    each_batch,
    keep_latest,
    numbered_in_window,
    pane_counts,
    running_count,
    slice_of,
    tumbling_counts,
    window_lists,
)

START = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)


def made_rows(seed, n=600, hot=0.0, hours=4):
    """(ts, event_id, uid): times with gaps and ties; a part of the rows at one instant."""
    rng = random.Random(seed)
    instants = [START + dt.timedelta(seconds=rng.randrange(hours * 3600)) for _ in range(n // 3)]
    hot_instant = START + dt.timedelta(minutes=95, microseconds=17)
    rows = [
        (hot_instant if rng.random() < hot else rng.choice(instants), i, str(rng.randrange(50)))
        for i in rng.sample(range(10 * n), n)
    ]
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, event_id long, uid string").repartition(5)


def by_window(rows, size=HOUR):
    windows = defaultdict(list)
    for row in sorted(rows):
        windows[START + size * ((row[0] - START) // size)].append(row)
    return windows


PLANS = {
    "groups": {"method": "groups"},
    "slices": {"method": "slices"},
    "slices, some large": {"method": "slices", "slice_rows": 5},
    "range": {"method": "range"},
    "auto, no large window": {},
    "auto, some windows large": {"slice_rows": 130},
    "auto, all windows large": {"slice_rows": 60},
    "auto, some slices large": {"slice_rows": 5},
}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_rows_are_numbered_in_arrival_order(spark, plan, hot):
    rows = made_rows(3, hot=hot)
    numbered = numbered_in_window(frame_of(spark, rows), "1 hour", last=True, **PLANS[plan])
    assert set(numbered.columns) == {"ts", "event_id", "uid", "window_start", "rn", "is_last"}
    found = {r.event_id: (r.window_start, r.rn, r.is_last) for r in numbered.collect()}
    assert len(found) == len(rows)
    for start, members in by_window(rows).items():
        for rn, row in enumerate(members, start=1):
            assert found[row[1]] == (start, rn, rn == len(members))


@pytest.mark.parametrize("plan", PLANS)
def test_batches_are_full_but_for_the_last(spark, plan):
    rows = made_rows(4, hot=0.3)
    tagged = count_batches(frame_of(spark, rows), "1 hour", 7, **PLANS[plan])
    found = {(r.window_start, r.batch_no): (r.n, r.first_id, r.last_id) for r in batch_summary(tagged).collect()}
    expected = {}
    for start, members in by_window(rows).items():
        for at in range(0, len(members), 7):
            batch = members[at : at + 7]
            expected[start, at // 7] = (len(batch), batch[0][1], batch[-1][1])
    assert found == expected
    sizes = pane_counts(frame_of(spark, rows), "1 hour", 7)
    assert {(r.window_start, r.batch_no): r.n for r in sizes.collect()} == {k: v[0] for k, v in expected.items()}


def test_golden_sample_gives_ten_and_six(spark):
    rows = [(START + dt.timedelta(seconds=n), n, str(1000 + n)) for n in range(1, 17)]
    tagged = count_batches(frame_of(spark, rows), "2 minutes", 10)
    batches = sorted((r.batch_no, r.n, r.first_id, r.last_id) for r in batch_summary(tagged).collect())
    assert batches == [(0, 10, 1, 10), (1, 6, 11, 16)]
    assert [r.n for r in tumbling_counts(frame_of(spark, rows), "2 minutes").collect()] == [16]


def test_lists_hold_the_window_in_order(spark):
    rows = made_rows(5, hot=0.3)
    listed = window_lists(frame_of(spark, rows), "1 hour", ["event_id", "uid"], list_rows=40)
    found = defaultdict(list)
    for r in listed.orderBy("window_start", "list_no").collect():
        assert r.list_no == len(found[r.window_start]) / 40 and r.n == len(r.records) <= 40
        found[r.window_start] += [tuple(record) for record in r.records]
    assert found == {w: [(i, uid) for _, i, uid in members] for w, members in by_window(rows).items()}


def test_reducers(spark):
    rows = made_rows(6, hot=0.3)
    windows = by_window(rows)
    counted = running_count(frame_of(spark, rows), "1 hour")
    expected = {m[1]: n for members in windows.values() for n, m in enumerate(members, start=1)}
    assert {r.event_id: r.c for r in counted.collect()} == expected
    last = keep_latest(frame_of(spark, rows), "1 hour")
    assert {r.window_start: (r.ts, r.event_id, r.uid) for r in last.collect()} == {
        start: members[-1] for start, members in windows.items()
    }


def test_durations():
    assert duration_micros("2 minutes") == 120_000_000
    assert slice_of("2 minutes", 60) == "2000000 microseconds"
    assert slice_of("7 microseconds", 60) == "1 microseconds"
    assert slice_of("1 day", 7) == "14400000000 microseconds"
    with pytest.raises(KeyError):
        duration_micros("3 fortnights")


def replayed(rows, size, limit, interval):
    """The contract, row by row."""
    found = []
    for start, members in by_window(rows, size).items():
        c, d, fired = 0, None, []
        for place, (ts, row_id, _) in enumerate(members):
            if d is not None and d <= ts:
                fired.append((d, "interval", place, members[place - 1][1]))
                c, d = 0, None
            c += 1
            if c >= limit:
                fired.append((ts, "count", place + 1, row_id))
                c, d = 0, None
            elif d is None:
                d = ts + interval
        if d is not None and d < start + size:
            fired.append((d, "interval", len(members), members[-1][1]))
        elif c:
            fired.append((start + size, "window_end", len(members), members[-1][1]))
        found += [(start, n, *pane) for n, pane in enumerate(fired, start=1)]
    return sorted(found)


@pytest.mark.parametrize(
    ("limit", "minutes", "block_rows", "fan"),
    [(5, 7, 10**6, 32), (5, 7, 16, 32), (5, 1, 5, 2), (3, 30, 4, 3), (1, 5, 9, 32), (50, 4, 50, 2), (9, 90, 10, 2)],
)
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_panes_follow_the_contract(spark, monkeypatch, limit, minutes, block_rows, fan, hot):
    monkeypatch.setattr(panes_module, "FAN", fan)
    rows = made_rows(limit + minutes, n=240, hot=hot, hours=2)
    found = panes(frame_of(spark, rows), "1 hour", limit, f"{minutes} minutes", block_rows=block_rows, slice_rows=60)
    expected = replayed(rows, HOUR, limit, dt.timedelta(minutes=minutes))
    assert sorted(map(tuple, found.collect())) == expected


def plain_replay(at, c, d, limit, interval):
    """The contract, row by row: panes (time, reason, rows before) and the state after."""
    fired = []
    for n, t in enumerate(at):
        if c and d <= t:
            fired.append((d, "interval", n))
            c = 0
        d = d if c else t + interval
        c += 1
        if c == limit:
            fired.append((t, "count", n + 1))
            c = 0
    return fired, c, d if c else panes_module.UNSET


@pytest.mark.parametrize(("limit", "interval"), [(1, 5), (1, 1), (4, 3), (7, 10**6), (16, 1), (100, 9)])
def test_replay_of_many_pieces(limit, interval):
    rng = random.Random(limit)
    for _ in range(60):
        at = np.sort(np.array([rng.randrange(80) for _ in range(rng.randrange(1, 40))], dtype=np.int64))
        cuts = sorted(rng.sample(range(1, len(at)), min(len(at) - 1, rng.randrange(5))))
        edges = np.array([0, *cuts, len(at)])
        c = np.array([rng.randrange(limit) for _ in edges[1:]], dtype=np.int64)
        d = np.array([at[e] + rng.randrange(-3, 9) for e in edges[:-1]], dtype=np.int64)
        got = panes_module.replay(at, edges, c, d, limit, interval)
        panes_of = list(zip(got.piece, got.at, np.where(got.by_count, "count", "interval"), got.upto, strict=True))
        for k, (begin, end) in enumerate(zip(edges, edges[1:], strict=False)):
            fired, c_end, d_end = plain_replay(at[begin:end].tolist(), int(c[k]), int(d[k]), limit, interval)
            assert [(int(t), r, int(u - begin)) for p, t, r, u in panes_of if p == k] == fired
            assert (got.c[k], got.d[k]) == (c_end, d_end)


@pytest.mark.parametrize(("limit", "interval"), [(4, 3), (1, 5), (7, 10**6), (16, 1)])
def test_block_tables_say_what_a_replay_does(limit, interval):
    rng = random.Random(limit)
    at = np.sort(np.array([rng.randrange(60) for _ in range(40)], dtype=np.int64))
    head, tail = at[:20], at[20:]
    table = panes_module.block_table(tail, limit, interval)
    for begin in range(20):
        first, c, d = plain_replay(head[begin:].tolist(), 0, panes_module.UNSET, limit, interval)
        rest, c_end, d_end = plain_replay(tail.tolist(), c, d, limit, interval)
        state = (np.array([c]), np.array([d]), np.array([len(first)]))
        got = [int(part[0]) for part in panes_module.through_block(table, *state, limit)]
        assert got[0] == c_end and got[2] == len(first) + len(rest)
        assert got[1] == d_end or c_end == 0


@pytest.mark.parametrize(("limit", "minutes", "block_rows"), [(5, 7, 10**6), (5, 3, 16), (1, 5, 9), (9, 90, 10)])
def test_panes_go_on_over_micro_batches(spark, tmp_path, limit, minutes, block_rows):
    """In micro-batches, each run twice as after a failure, the panes are those of the rows in one."""
    rows = sorted(made_rows(limit, n=240, hot=0.3, hours=2))
    found = set()
    for batch_id, begin in enumerate([0, 100, 101, 180, None]):
        ends = {0: 100, 100: 101, 101: 180, 180: 240}
        part = rows[begin : ends[begin]] if begin is not None else []
        now = part[-1][0] if part else rows[-1][0] + dt.timedelta(days=1)
        frame = frame_of(spark, part) if part else frame_of(spark, rows).limit(0)
        for _ in range(2):
            fired = panes_module.carried_panes(
                frame, "1 hour", limit, f"{minutes} minutes", str(tmp_path), batch_id,
                int(now.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000), block_rows=block_rows, slice_rows=60,
            )
            got = set(map(tuple, fired.collect()))
        found |= got
    assert sorted(found) == replayed(rows, HOUR, limit, dt.timedelta(minutes=minutes))


def test_last_pane_holds_the_window(spark):
    rows = made_rows(8)
    found = panes(frame_of(spark, rows), "1 hour", 20, "5 minutes")
    last = found.groupBy("window_start").agg(F.max_by("n_rows", "pane_no").alias("n"))
    assert {r.window_start: r.n for r in last.collect()} == {w: len(m) for w, m in by_window(rows).items()}


def test_panes_by_count_are_those_of_a_long_interval(spark):
    rows = made_rows(9, hot=0.2)
    long = panes(frame_of(spark, rows), "1 hour", 20, "1 hour").drop("fired_at")
    short = panes_by_count(frame_of(spark, rows), "1 hour", 20).select(long.columns)
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, short.collect()))


def test_a_row_without_a_time_fails_the_query(spark):
    rows = made_rows(1, n=30) + [(None, -1, "1")]
    with pytest.raises(Exception, match="no arrival time"):
        tumbling_counts(frame_of(spark, rows), "1 hour").collect()


def test_carried_batches_are_those_of_the_rows_in_one(spark, tmp_path):
    rows = sorted(made_rows(11, n=200, hot=0.2))
    folder, found = str(tmp_path), {}
    for batch_id, begin in enumerate(range(0, 200, 60)):
        part = frame_of(spark, rows[begin : begin + 60])
        for _ in range(2):
            tagged = carried_batches(part, "1 hour", 7, folder, batch_id, slice_rows=25)
            found.update({r.event_id: (r.window_start, r.rn, r.batch_no) for r in tagged.collect()})
    assert found == {
        m[1]: (start, rn, (rn - 1) // 7)
        for start, members in by_window(rows).items()
        for rn, m in enumerate(members, start=1)
    }


def test_sizes_of_batches_of_a_very_large_window(spark):
    counted = spark.sql("select 0 as window_start, 3000000000L as n")
    sizes = batch_sizes(counted, 1)
    assert len(sizes.limit(5).collect()) == 5
    few = batch_sizes(spark.sql(f"select 0 as window_start, {NUMBER_BLOCK * 3 + 2}L as n"), 2)
    assert few.count() == NUMBER_BLOCK * 3 // 2 + 1
    assert few.agg(F.sum("n")).first()[0] == NUMBER_BLOCK * 3 + 2


def test_totals_are_kept_for_all_windows(spark, tmp_path):
    rows = made_rows(12, n=100)
    carried_batches(frame_of(spark, rows), "1 hour", 7, str(tmp_path), 0)
    kept = spark.read.parquet(str(tmp_path / "totals"))
    assert sorted(r.window_start for r in kept.collect()) == sorted(by_window(rows))


def micros(moment):
    return int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def fired_in(spark, tmp_path, parts, threshold, **how):
    """Rows that fire, by micro-batch; parts: (rows, clock). Each micro-batch runs twice."""
    found = []
    for batch_id, (part, now) in enumerate(parts):
        frame = frame_of(spark, part) if part else frame_of(spark, made_rows(1, n=30)).limit(0)
        for _ in range(2):
            fired = held_batches(frame, "1 hour", threshold, str(tmp_path), batch_id, micros(now), **how)
            got = [(r.event_id, r.window_start, r.rn, r.batch_no, r.reason) for r in fired.collect()]
        found.append(got)
    return found


@pytest.mark.parametrize(("threshold", "slice_rows"), [(7, 25), (1, 1000), (1000, 30)])
def test_held_batches_are_those_of_the_rows_in_one(spark, tmp_path, threshold, slice_rows):
    rows = sorted(made_rows(21, n=200, hot=0.3))
    cuts = [0, 60, 61, 140, 200]
    parts = [(rows[a:b], rows[b - 1][0]) for a, b in zip(cuts, cuts[1:], strict=False)] + [([], START + 24 * HOUR)]
    found = fired_in(spark, tmp_path, parts, threshold, slice_rows=slice_rows)
    expected = {
        (m[1], start, rn, (rn - 1) // threshold, "count" if (rn - 1) // threshold < len(members) // threshold else "window_end")
        for start, members in by_window(rows).items()
        for rn, m in enumerate(members, start=1)
    }
    fired = [row for part in found for row in part]
    assert set(fired) == expected and len(fired) == 200
    # A batch is given whole, in one micro-batch, and nothing is left.
    given = defaultdict(set)
    for k, part in enumerate(found):
        for _, start, _, batch_no, _ in part:
            given[start, batch_no].add(k)
    assert all(len(ks) == 1 for ks in given.values())


def test_rows_after_their_windows_end_are_new_batches(spark, tmp_path):
    at = lambda n: (START + dt.timedelta(seconds=n), n, "u")
    parts = [([at(0), at(1), at(2)], START), ([], START + HOUR), ([at(3), at(4)], START + 2 * HOUR), ([at(n) for n in range(5, 10)], START + 2 * HOUR)]
    found = fired_in(spark, tmp_path, parts, 4)
    assert [sorted((r[0], r[3], r[4]) for r in part) for part in found] == [
        [], [(n, 0, "window_end") for n in range(3)], [(n, 1, "window_end") for n in (3, 4)],
        [(n, 2, "count") for n in range(5, 9)] + [(9, 3, "window_end")],
    ]


def test_nothing_piles_up_over_micro_batches(spark, tmp_path):
    def sizes():
        return {p.parent.name for p in tmp_path.rglob("*.parquet")}, len({p.parent for p in tmp_path.rglob("*.parquet")})

    seen = set()
    for batch_id in range(10):
        rows = [(START + dt.timedelta(seconds=batch_id * 10 + k), batch_id * 10 + k, "u") for k in range(10)]
        held_batches(frame_of(spark, rows), "1 hour", 4, str(tmp_path), batch_id, micros(START)).collect()
        seen.add(sizes()[1])
    assert max(seen) <= 6  # two turns of totals, of fired rows and of waiting ones


def test_windows_are_given_once_at_their_end(spark, tmp_path):
    at = lambda n: (START + dt.timedelta(minutes=n), n, "u")
    given = []
    for batch_id, (part, now) in enumerate(
        [([at(0), at(59), at(61)], START), ([at(30)], START + HOUR), ([], START + HOUR), ([at(119)], START + HOUR), ([], START + 3 * HOUR), ([at(5)], START + 3 * HOUR)]
    ):
        frame = frame_of(spark, part) if part else frame_of(spark, [at(0)]).limit(0)
        for _ in range(2):
            ended = ended_windows(frame, "1 hour", str(tmp_path), batch_id, micros(now)).collect()
        given.append(sorted((r.window_start, r.n) for r in ended))
    assert given == [[], [(START, 3)], [], [], [(START + HOUR, 2)], [(START, 1)]]


def test_a_function_over_every_batch(spark):
    rows = made_rows(5, n=300, hot=0.5)
    calls = []

    def longest(start, batch_no, batch):
        import pyarrow as pa

        return pa.RecordBatch.from_pydict({"n": [batch.num_rows], "no": [batch_no], "ids": [batch["event_id"].to_pylist()]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        calls = each_batch(count_batches(frame_of(spark, rows), "1 hour", 40, slice_rows=60), longest, "n long, no long, ids array<long>").collect()
        none = each_batch(count_batches(frame_of(spark, rows).limit(0), "1 hour", 40), longest, "n long, no long, ids array<long>").count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = [[m[1] for m in members[k : k + 40]] for members in by_window(rows).values() for k in range(0, len(members), 40)]
    assert sorted(r.ids for r in calls) == sorted(expected) and none == 0
