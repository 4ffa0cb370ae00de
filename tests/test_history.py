"""Type-2 history: the set-based rebuild, one-batch application and the stored table must agree."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alluvia.operators import scd2
from alluvia.operators.neighbours import with_neighbour
from alluvia.sinks.history import HistoryTable
from alluvia.sinks.folders import exists, remove
from alluvia.sinks.tables import COMMIT_MARKER

SPEC = scd2.HistorySpec(keys=("id", "region"), tracked=("tier", "wins"), carried=("note",), order=("t",))
DDL = "id int, region string, tier string, wins int, note string, t int"
START = datetime(2024, 1, 1)


def at(number):
    return START + timedelta(hours=number)


def facts(df):
    """History rows without the columns that only repeat others."""
    return sorted(
        (r.id, r.region, r.tier or "", r.wins or 0, r.effective_date, r.end_date or datetime.max, r.is_current)
        for r in df.collect()
    )


def by_hand(batches):
    """Brute force over plain Python rows."""
    current, done = {}, []
    for number, batch in enumerate(batches):
        last = {}
        for row in batch:
            key = (row[0], row[1])
            if None not in key and (key not in last or rank(row) > rank(last[key])):
                last[key] = row
        for key, row in last.items():
            value = (row[2] or "", row[3])
            if key in current and current[key][0] == value:
                continue
            if key in current:
                done.append((*key, *current[key][0], current[key][1], at(number), False))
            current[key] = (value, at(number))
    rows = done + [(*k, *v, since, datetime.max, True) for k, (v, since) in current.items()]
    return sorted((i, r, tier, wins or 0, *rest) for i, r, tier, wins, *rest in rows)


def rank(row):
    """Order within a batch: t, then the other stored columns, NULL lowest."""
    return tuple((v is not None, v if v is not None else 0) for v in (row[5], row[2], row[3], row[4]))


def log_of(spark, batches):
    rows = [(*row, at(number)) for number, batch in enumerate(batches) for row in batch]
    return spark.createDataFrame(rows, DDL + ", at timestamp")


def check_invariants(df, keys=("id", "region")):
    per_key = {}
    for r in df.collect():
        assert r.is_current == (r.end_date is None)
        per_key.setdefault(tuple(r[k] for k in keys), []).append(r)
    for versions in per_key.values():
        versions.sort(key=lambda r: r.effective_date)
        assert sum(r.is_current for r in versions) == 1
        for earlier, later in zip(versions, versions[1:]):
            assert earlier.end_date == later.effective_date
            assert earlier.hash_key != later.hash_key
        assert len({r.surrogate_key for r in versions}) == len(versions)


BATCHES = [
    [(1, "a", "x", 1, "n", 1), (1, "a", "y", 1, "n", 2), (2, "a", "x", 1, "n", 1), (None, "a", "x", 1, "n", 1)],
    [(1, "a", "y", 1, "other note", 1), (2, "a", "z", 1, "n", 1), (2, None, "z", 1, "n", 1)],
    [],
    [(2, "a", "x", 1, "n", 1), (3, "b", None, None, "n", 1), (3, "b", None, None, "n", 1)],
    [(3, "b", None, 0, "n", 1), (1, "b", "q", 1, "n", 1), (1, "a", "y", 1, "n", 9)],
]


def applied(spark, batches):
    history = None
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, DDL)
        if history is None:
            history = scd2.stamp(scd2.last_of_batch(df, SPEC), SPEC, at(number))
        else:
            history = scd2.apply_batch(history, df, SPEC, at(number))
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def stored(spark, path, batches, buckets=3):
    table = HistoryTable(spark, path, SPEC, buckets)
    for number, batch in enumerate(batches):
        table.apply(spark.createDataFrame(batch, DDL), at(number))
    return table


def test_three_ways_agree(spark, here):
    wanted = by_hand(BATCHES)
    rebuilt = scd2.rebuild_history(log_of(spark, BATCHES), SPEC, "at")
    assert facts(rebuilt) == wanted
    check_invariants(rebuilt)
    assert facts(applied(spark, BATCHES)) == wanted
    table = stored(spark, f"{here}/h", BATCHES)
    assert facts(table.read()) == wanted
    assert facts(table.current()) == [r for r in wanted if r[-1]]
    check_invariants(table.read())
    assert table.read().columns == SPEC.layout


def test_hash_and_layout_agree_with_rebuild(spark, here):
    stable = ["id", "region", "hash_key", "surrogate_key", "effective_date", "year", "month", "day", "note"]
    one = stored(spark, f"{here}/h", BATCHES).read().select(*stable)
    two = scd2.rebuild_history(log_of(spark, BATCHES), SPEC, "at").select(*stable)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


ROW = st.tuples(
    st.integers(1, 3), st.sampled_from(["a", "b"]), st.sampled_from(["x", "y", None]), st.integers(0, 1),
    st.just("n"), st.integers(0, 2),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ROW, max_size=5), min_size=1, max_size=6))
def test_rebuild_equals_brute_force(spark, batches):
    log = log_of(spark, batches)
    wanted = by_hand(batches)
    assert facts(scd2.rebuild_history(log, SPEC, "at")) == wanted
    segmented = scd2.rebuild_history(log, SPEC, "at", segment=F.floor(F.hour("at") / 2))
    assert facts(segmented) == wanted


def test_optional_keys_treat_null_as_a_value(spark, here):
    spec = scd2.HistorySpec(("id", "region"), ("tier",), order=("t",), required=("id",))
    batches = [
        [(1, None, "x", 0, "", 1), (1, "a", "x", 0, "", 1), (None, "a", "x", 0, "", 1)],
        [(1, None, "x", 0, "", 1), (1, "a", "y", 0, "", 1)],
        [(1, None, "z", 0, "", 1)],
    ]
    table, history = HistoryTable(spark, f"{here}/h", spec), None
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, DDL)
        table.apply(df, at(number))
        history = (
            scd2.apply_batch(history, df, spec, at(number)) if history
            else scd2.stamp(scd2.last_of_batch(df, spec), spec, at(number))
        )
    wanted = {
        (1, None, "x", at(0), at(2)), (1, None, "z", at(2), None), (1, "a", "x", at(0), at(1)), (1, "a", "y", at(1), None),
    }
    log = log_of(spark, batches)
    for df in (
        table.read(), history, scd2.rebuild_history(log, spec, "at"),
        scd2.rebuild_history(log, spec, "at", segment=F.hour("at")),
    ):
        assert {(r.id, r.region, r.tier, r.effective_date, r.end_date) for r in df.collect()} == wanted
        check_invariants(df)


def test_segments_split_a_hot_key(spark):
    rows = [(1, i, i % 7) for i in range(300)] + [(2, i, 0) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(5)
    for previous in (True, False):
        plain = with_neighbour(df, ["k"], ["o"], "v", "n", previous)
        cut = with_neighbour(df, ["k"], ["o"], "v", "n", previous, segment=F.floor(F.col("o") / 11))
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, cut.collect()), key=str)


def test_replay_changes_nothing(spark, here):
    table = stored(spark, f"{here}/h", BATCHES[:2])
    before = facts(table.read())
    assert not table.apply(spark.createDataFrame(BATCHES[1], DDL), at(1))
    assert not table.apply(spark.createDataFrame(BATCHES[1], DDL), at(6))
    assert not table.apply(spark.createDataFrame([], DDL), at(7))
    assert facts(table.read()) == before


def places(spark, path):
    """Files of a table with what they hold, by directory."""
    rows = spark.read.parquet(f"{path}/rows").select("*", F.input_file_name().alias("file"))
    found = {}
    for r in rows.collect():
        found.setdefault((r.bucket, str(r.closed_on)), set()).add(r.file)
    return found


def test_a_batch_touches_its_own_buckets_only(spark, here):
    table = HistoryTable(spark, f"{here}/h", SPEC, 8)
    table.apply(spark.createDataFrame([(n, "a", "x", 1, "n", 1) for n in range(80)], DDL), at(0))
    before = places(spark, f"{here}/h")
    assert len(before) == 8
    bucket = table.read().transform(table.with_bucket).filter("id = 7").first().bucket
    # The batch holds a second bucket's key too, as it was: read, but not replaced.
    same = table.read().transform(table.with_bucket).filter(F.col("bucket") != bucket).first().id
    assert table.apply(spark.createDataFrame([(7, "a", "y", 1, "n", 1), (same, "a", "x", 1, "n", 1)], DDL), at(30))
    after = places(spark, f"{here}/h")
    assert {k: v for k, v in after.items() if k[0] != bucket} == {k: v for k, v in before.items() if k[0] != bucket}
    assert after[bucket, "open"] != before[bucket, "open"] and (bucket, "2024-01-02") in after
    # A later day leaves the rows closed on the earlier one where they are.
    assert table.apply(spark.createDataFrame([(7, "a", "z", 1, "n", 1)], DDL), at(60))
    last = places(spark, f"{here}/h")
    assert last[bucket, "2024-01-02"] == after[bucket, "2024-01-02"] and (bucket, "2024-01-03") in last
    assert [(r.tier, r.is_current) for r in table.read().filter("id = 7").orderBy("effective_date").collect()] == [
        ("x", False), ("y", False), ("z", True)]


def test_a_change_that_was_written_is_finished(spark, here):
    table = stored(spark, f"{here}/h", BATCHES[:1])
    # A job that died between writing its change and copying it: the change is certain, and the next look finishes it.
    table.settle, finish = lambda *_: None, table.settle
    table.apply(spark.createDataFrame(BATCHES[1], DDL), at(1))
    assert exists(spark, f"{here}/h/pending") and facts(table.read()) == by_hand(BATCHES[:1])
    table.settle = finish
    assert facts(HistoryTable(spark, f"{here}/h", SPEC).read()) == by_hand(BATCHES[:2])
    assert not exists(spark, f"{here}/h/pending")
    assert not table.apply(spark.createDataFrame(BATCHES[1], DDL), at(1))
    # One that died while copying has lost a bucket of the table, not of the change.
    table.settle = lambda *_: None
    table.apply(spark.createDataFrame(BATCHES[3], DDL), at(3))
    remove(spark, f"{here}/h/rows/bucket={table.read().transform(table.with_bucket).filter('id = 2').first().bucket}/closed_on=open")
    table.settle = finish
    assert facts(table.read()) == by_hand([*BATCHES[:2], [], BATCHES[3]])


def test_a_change_without_a_marker_is_dropped(spark, here):
    table = stored(spark, f"{here}/h", BATCHES[:1])
    unmarked = table.read().transform(table.with_bucket).withColumn("closed_on", F.lit("open")).withColumn("tier", F.lit("?"))
    unmarked.write.option(COMMIT_MARKER, "false").partitionBy("bucket", "closed_on").parquet(f"{here}/h/pending")
    assert facts(table.read()) == by_hand(BATCHES[:1])
    assert table.apply(spark.createDataFrame(BATCHES[1], DDL), at(1))
    assert facts(table.read()) == by_hand(BATCHES[:2])


def test_a_table_keeps_its_number_of_buckets(spark, here):
    stored(spark, f"{here}/h", BATCHES[:2], buckets=3)
    again = HistoryTable(spark, f"{here}/h", SPEC, 50)
    for number in (2, 3, 4):
        again.apply(spark.createDataFrame(BATCHES[number], DDL), at(number))
    assert again.buckets == 3 and facts(again.read()) == by_hand(BATCHES)


def test_a_failing_batch_keeps_the_table(spark, here):
    table = stored(spark, f"{here}/h", BATCHES[:2])
    before = facts(table.read())
    broken = spark.createDataFrame(BATCHES[3], DDL).withColumn("wins", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        table.apply(broken, at(2))
    assert facts(table.read()) == before


def test_view_needs_no_renewal(spark, here):
    table = stored(spark, f"{here}/h", BATCHES[:2])
    early = table.view_sql()
    for number in (2, 3, 4):
        table.apply(spark.createDataFrame(BATCHES[number], DDL), at(number))
    view, wanted = spark.sql(early), table.read()
    assert view.columns == SPEC.layout
    assert view.exceptAll(wanted).count() == 0 and wanted.exceptAll(view).count() == 0
    assert facts(spark.sql(early)) == by_hand(BATCHES)


def test_backfill_then_batches(spark, here):
    for cut in range(1, len(BATCHES) + 1):
        table = HistoryTable(spark, f"{here}/h{cut}", SPEC, 3)
        table.backfill(log_of(spark, BATCHES), "at", at(cut))
        for number in range(cut, len(BATCHES)):
            table.apply(spark.createDataFrame(BATCHES[number], DDL), at(number))
        assert facts(table.read()) == by_hand(BATCHES)
        with pytest.raises(ValueError):
            table.backfill(log_of(spark, BATCHES), "at", at(cut))


def test_current_rows_prune_closed_directories(spark, here):
    table = stored(spark, f"{here}/h", BATCHES)
    text = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "closed_on" in text[text.index("PartitionFilters"):].split("PushedFilters")[0]


def test_missing_table(spark, here):
    table = HistoryTable(spark, f"{here}/none", SPEC)
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
