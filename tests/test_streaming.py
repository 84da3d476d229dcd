from __future__ import annotations

import json
import os
import time
from datetime import date
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from apptlake.plans import batch, serving
from apptlake.plans.batch import Layout
from apptlake.sources import landing
from apptlake.sources.records import RECORD, body_lines, file_records
from apptlake.sources.tables import load_declared, published
from apptlake.streaming.ingest import start_landing, start_tee
from apptlake.streaming.live import (
    appended,
    latest_items,
    live_items,
    live_snapshot,
    live_table,
    start_dedup_append,
    start_live,
    typed_live,
)
from apptlake.streaming.progress import BatchCounts
from samples import FACEBOOK, TIKTOK, YOUTUBE, document, records, values


def arrive(spark, folder, bodies, first=0):
    """One file of records, numbered from ``first``."""
    rows = records(spark, bodies).selectExpr("key", "value", f"sequence + {first} AS sequence")
    rows.coalesce(1).write.mode("append").parquet(folder)


def run_live(spark, inbox, folder, files_per_batch=1):
    stream = file_records(spark, inbox, max_files_per_batch=files_per_batch)
    start_live(stream, f"{folder}/live", f"{folder}/cp", pull_seconds=None).awaitTermination()
    return live_snapshot(spark, f"{folder}/live")


def source(name):
    return {"tracking": {"utm_source": name}}


def test_micro_batches_end_where_one_batch_would(spark, folder):
    inbox = f"{folder}/in"
    bodies = [
        [document("u/1", **source("a")), document("u/2"), document("u/1", **source("b"))],
        [document("u/2", **source("c")), document("u/3", event_type="other"), "{broken"],
        [document("u/4", event="invitee.canceled"), document(None), document("u/5")],
    ]
    for number, part in enumerate(bodies):
        arrive(spark, inbox, part, first=10 * number)
    got = run_live(spark, inbox, folder)
    assert got.columns == [
        "booking_id",
        "booking_date",
        "channel",
        "utm_source",
        "host_email",
        "host_name",
        "start_time",
        "end_time",
    ]
    assert values(got, "booking_id", "utm_source") == [("u/1", "b"), ("u/2", "c"), ("u/5", "news")]
    everything = spark.read.schema(RECORD).parquet(inbox)
    assert values(typed_live(latest_items(live_items(everything)))) == values(got)


def test_a_restart_goes_on_from_the_checkpoint(spark, folder):
    inbox = f"{folder}/in"
    arrive(spark, inbox, [document("u/1", **source("a"))])
    run_live(spark, inbox, folder)
    arrive(spark, inbox, [document("u/1", **source("b")), document("u/2")], first=5)
    got = run_live(spark, inbox, folder)
    assert values(got, "booking_id", "utm_source") == [("u/1", "b"), ("u/2", "news")]


def test_a_stream_without_live_items_leaves_an_empty_table(spark, folder):
    arrive(spark, f"{folder}/in", [document(event="other")])
    assert run_live(spark, f"{folder}/in", folder).isEmpty()
    assert live_snapshot(spark, f"{folder}/never").isEmpty()


def test_the_order_of_arrival_decides_not_the_order_of_batches(spark, folder):
    arrive(spark, f"{folder}/in", [document("u/1", **source("seq 9"))], first=9)
    run_live(spark, f"{folder}/in", folder)
    arrive(spark, f"{folder}/in", [document("u/1", **source("seq 0"))])
    assert values(run_live(spark, f"{folder}/in", folder), "utm_source") == [("seq 9",)]


def test_live_days_before_since_are_not_read(spark, folder):
    old = document("u/1", created_at="2026-02-01T09:00:00Z")
    arrive(spark, f"{folder}/in", [old, document("u/2")])
    run_live(spark, f"{folder}/in", folder)
    recent = live_table(spark, f"{folder}/live", since=date(2026, 2, 15))
    assert values(recent, "booking_id") == [("u/2",)]
    assert "PartitionFilters: [isnotnull(day" in recent._jdf.queryExecution().executedPlan().toString()


def test_files_with_an_old_time_stamp_are_read(spark, folder):
    arrive(spark, f"{folder}/in", [document("u/1")])
    run_live(spark, f"{folder}/in", folder)
    arrive(spark, f"{folder}/in", [document("u/2")], first=5)
    new = max(Path(folder, "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime)
    month_ago = time.time() - 30 * 86400
    os.utime(new, (month_ago, month_ago))
    got = run_live(spark, f"{folder}/in", folder)
    assert values(got, "booking_id") == [("u/1",), ("u/2",)]


def run_append(spark, inbox, folder):
    items = live_items(file_records(spark, inbox, max_files_per_batch=1))
    start_dedup_append(items, f"{folder}/out", f"{folder}/cp").awaitTermination()
    return appended(spark, f"{folder}/out")


def test_append_only_stream_drops_replays(spark, folder):
    inbox = f"{folder}/in"
    arrive(spark, inbox, [document("u/1"), document("u/2"), document("u/1", **source("b"))])
    first = values(run_append(spark, inbox, folder).drop('ingested_at'))
    arrive(spark, inbox, [document("u/1"), document("u/2"), document("u/1", **source("b"))])
    assert values(run_append(spark, inbox, folder).drop('ingested_at')) == first
    arrive(spark, inbox, [document("u/2"), document("u/3")], first=5)
    found = run_append(spark, inbox, folder)
    assert values(found, "booking_id", "sequence") == [("u/1", 2), ("u/2", 5), ("u/3", 6)]
    # A replay was stored once, a newer item beside the one before.
    assert spark.read.schema("sequence long").parquet(f"{folder}/out").count() == 4


def test_append_only_stream_loses_nothing_however_late_it_comes(spark, folder):
    inbox = f"{folder}/in"
    bodies = [
        document(f"u/{n % 4}", created_at=f"2026-03-{1 + n:02}T09:00:00Z", **source(f"s{n}")) for n in range(8)
    ]
    numbered = list(enumerate(bodies)) + [(20, document(None)), (21, document(None, **source("b")))]
    straggler = (30, document("late", created_at="2026-02-09T09:00:00Z"))
    for number, body in [*numbered[::-1], straggler, numbered[0]]:
        arrive(spark, inbox, [body], first=number)
    found = run_append(spark, inbox, folder)
    everything = live_items(spark.read.schema(RECORD).parquet(inbox))
    expected = values(latest_items(everything).drop("ingested_at"))
    assert values(found.where("booking_id IS NOT NULL").drop("ingested_at")) == expected
    assert found.where("booking_id IS NULL").count() == 2
    assert ("late",) in values(found, "booking_id")


def test_ten_micro_batches_leave_one_row_of_a_booking(spark, folder):
    inbox = f"{folder}/in"
    for n in range(10):
        day = f"2026-03-{1 + n % 3:02}T09:00:00Z"
        arrive(spark, inbox, [document("u/1", created_at=day, **source(f"s{n}")), document(f"v/{n}")], first=10 * n)
    got = run_live(spark, inbox, folder)
    assert values(got.where("booking_id = 'u/1'"), "utm_source", "booking_date") == [("s9", date(2026, 3, 1))]
    assert got.count() == 11
    stored = load_declared(spark, f"{folder}/live", "booking_id string, sequence long")
    assert stored.where("booking_id IS NOT NULL").count() == 11
    plan = live_table(spark, f"{folder}/live")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_a_restart_by_wider_rules_keeps_the_state_it_had(spark, folder):
    """What the checkpoint holds is read through the state data source before and after."""
    inbox = f"{folder}/in"
    arrive(spark, inbox, [document("u/1"), document("u/2", event_type="podcast")])

    def state():
        rows = spark.read.format("statestore").load(f"{folder}/cp")
        return values(rows.select("key.booking_id"))

    run_live(spark, inbox, folder)
    assert state() == [("u/1",)]
    arrive(spark, inbox, [document("u/3", event_type="podcast")], first=5)
    rules = {FACEBOOK: "facebook_paid_ads", "podcast": "podcast_ads"}
    stream = file_records(spark, inbox)
    start_live(stream, f"{folder}/live", f"{folder}/cp", rules, pull_seconds=None).awaitTermination()
    assert state() == [("u/1",), ("u/3",)]
    assert values(live_snapshot(spark, f"{folder}/live"), "booking_id") == [("u/1",), ("u/3",)]


def test_pulls_at_an_interval_take_so_many_bytes_each(spark, folder):
    inbox = f"{folder}/in"
    for n in range(3):
        arrive(spark, inbox, [document(f"u/{n}")], first=n)
    stream = file_records(spark, inbox, max_bytes_per_batch=1)
    query = start_live(stream, f"{folder}/live", f"{folder}/cp", pull_seconds=1)
    try:
        query.processAllAvailable()
        arrive(spark, inbox, [document("u/9")], first=9)
        query.processAllAvailable()
        pulls = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert pulls == [1, 1, 1, 1]
    assert len(values(live_snapshot(spark, f"{folder}/live"), "booking_id")) == 4


def test_running_streams_count_what_they_take_and_write(spark, folder):
    layout, counts = Layout(folder), BatchCounts()
    spark.streams.addListener(counts)
    try:
        landing.land(records(spark, [document("u/1"), document("u/2"), "{broken"]), layout.path("landing"))
        batch.ingest_bronze(spark, layout)
        arrive(spark, f"{folder}/in", [document("u/1"), document("u/2", event_type="x"), document("u/3")])
        run_live(spark, f"{folder}/in", folder)
        for _ in range(50):
            totals = {name.rsplit("-", 1)[0]: counts.total(name) for name in list(counts.batches)}
            if len(totals) == 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(counts)
    assert totals == {"kept-quarantined": {"read": 3, "kept": 2, "quarantined": 1}, "live": {"read": 3, "live": 2}}


def test_lines_of_bare_bodies_are_records_too(spark, folder):
    inbox = Path(folder, "in")
    inbox.mkdir()
    lines = [json.dumps(document("u/1")), json.dumps(document("u/2"))]
    (inbox / "a.jsonl").write_text("\n".join(lines))
    stream = body_lines(spark, str(inbox))
    start_live(stream, f"{folder}/live", f"{folder}/cp", pull_seconds=None).awaitTermination()
    assert values(live_table(spark, f"{folder}/live"), "booking_id") == [("u/1",), ("u/2",)]


def test_lines_of_a_booking_are_ordered_by_their_own_time(spark, folder):
    inbox = Path(folder, "in")
    inbox.mkdir()
    made = [f"2026-03-01T09:00:0{n}Z" for n in (2, 4, 1, 3, 0)]
    lines = [json.dumps(document("u/1", created_at=at, **source(at))) for at in made]
    (inbox / "a.jsonl").write_text("\n".join(lines))
    stream = body_lines(spark, str(inbox))
    start_live(stream, f"{folder}/live", f"{folder}/cp", pull_seconds=None).awaitTermination()
    assert values(live_table(spark, f"{folder}/live"), "utm_source") == [(made[1],)]


def test_tee_feeds_landing_and_live_table(spark, folder):
    inbox = f"{folder}/in"
    arrive(spark, inbox, [document("u/1"), document("u/1", event="invitee.canceled"), "{broken"])
    stream = file_records(spark, inbox)
    for query in start_tee(stream, f"{folder}/land", f"{folder}/live", f"{folder}/cp"):
        query.awaitTermination()
    landed = landing.stored(spark, f"{folder}/land")
    assert values(landed, "sequence", "date") == [(0, "2026-03-01"), (1, "2026-03-01"), (2, None)]
    assert values(live_snapshot(spark, f"{folder}/live"), "booking_id") == [("u/1",)]


def test_bronze_takes_each_landed_file_once(spark, folder):
    layout = Layout(folder)
    landing.land(records(spark, [document("u/1"), "{broken"]), layout.path("landing"))
    assert batch.ingest_bronze(spark, layout) == 2
    landing.land(records(spark, [document("u/2")]), layout.path("landing"))
    assert batch.ingest_bronze(spark, layout) == 1
    rows = batch.bronze(spark, layout)
    assert values(rows, "booking_id", "sequence") == [("u/1", 0), ("u/2", 0)]
    assert rows.where("_source_file like '%landing%' and ingest_date is not null").count() == 2
    assert values(batch.quarantine(spark, layout), "value") == [("{broken",)]


def test_a_failed_run_leaves_no_row_twice(spark, folder):
    layout = Layout(folder)
    landing.land(records(spark, [document("u/1"), "{broken"]), layout.path("landing"))
    batch.ingest_bronze(spark, layout)
    # As if the job had died after its files were written and before the checkpoint said so.
    for mark in Path(folder, "checkpoints/bronze/commits").iterdir():
        if mark.is_file():
            mark.unlink()
    batch.ingest_bronze(spark, layout)
    assert values(batch.bronze(spark, layout), "booking_id") == [("u/1",)]
    assert batch.quarantine(spark, layout).count() == 1


def spend_day(folder, day, rows):
    place = Path(folder, "spend")
    place.mkdir(exist_ok=True)
    (place / f"spend_data_{day}.json").write_text(json.dumps(rows))


def test_batch_run_end_to_end(spark, folder):
    layout = Layout(folder)
    day = date(2026, 3, 1)
    landing.land(
        records(
            spark,
            [document("u/1"), document("u/2", event_type=YOUTUBE), document("u/3", event_type="x")],
        ),
        layout.path("landing"),
    )
    rows = batch.run_batch(spark, layout, day)
    assert rows == {
        "bronze": 3,
        "silver_events": 3,
        "silver_spends": 0,
        "bookings_by_source_daily": 1,
        "booking_time_distribution": 1,
        "cpb_by_channel": 2,
        "employee_meeting_load": 1,
        "active_hosts_daily": 1,
    }
    spend_day(folder, day, [{"channel": "facebook_paid_ads", "date": "2026-03-01", "spend": 8}])
    landing.land(
        records(
            spark,
            [
                document("u/1", created_at="2026-03-02T09:00:00Z", event="invitee.canceled"),
                document("u/4", event_type=TIKTOK, created_at="2026-03-02T09:00:00Z"),
            ],
        ),
        layout.path("landing"),
    )
    batch.run_batch(spark, layout, day)
    bookings = batch.silver_bookings(spark, layout)
    assert values(bookings, "booking_id", "channel") == [
        ("u/1", "facebook_paid_ads"),
        ("u/2", "youtube_paid_ads"),
        ("u/4", "tiktok_paid_ads"),
    ]
    cost = batch.gold_table(spark, layout, "cpb_by_channel")
    assert values(cost) == [
        ("facebook_paid_ads", 1, 8.0, 8.0),
        ("tiktok_paid_ads", 1, 0.0, 0.0),
        ("youtube_paid_ads", 1, 0.0, 0.0),
    ]
    daily = batch.gold_table(spark, layout, "bookings_by_source_daily")
    assert values(daily) == [(date(2026, 3, 1), "news", 1), (date(2026, 3, 2), "news", 2)]


def test_a_first_run_without_a_landing_is_quiet(spark, folder):
    layout = Layout(folder)
    assert set(batch.run_batch(spark, layout, date(2026, 3, 1)).values()) == {0}
    assert not batch.refresh_silver_bookings(spark, layout)
    assert not batch.refresh_silver_spends(spark, layout, date(2026, 3, 1))
    inputs = batch.serving_inputs(spark, layout)
    assert inputs.daily.isEmpty() and inputs.live.isEmpty()


def test_a_broken_spend_file_fails_but_does_not_hold_up_bookings(spark, folder):
    layout, day = Layout(folder), date(2026, 3, 1)
    landing.land(records(spark, [document("u/1")]), layout.path("landing"))
    place = Path(folder, "spend")
    place.mkdir()
    (place / f"spend_data_{day}.json").write_text('[{"channel": "fb", "spe')
    with pytest.raises(Exception, match="spend record that cannot be read"):
        batch.run_batch(spark, layout, day)
    assert values(batch.silver_bookings(spark, layout), "booking_id") == [("u/1",)]


def test_a_booking_leaves_silver_when_a_later_event_moves_it(spark, folder):
    layout = Layout(folder)
    moved = document("u/1", created_at="2026-03-04T09:00:00Z", event_type="other")
    for body in (document("u/1"), moved):
        landing.land(records(spark, [body]), layout.path("landing"))
        batch.ingest_bronze(spark, layout)
        batch.extend_silver_bookings(spark, layout)
    assert batch.silver_bookings(spark, layout).isEmpty()


EVENT = st.tuples(st.sampled_from(["u/1", "u/2"]), st.integers(1, 3), st.sampled_from([FACEBOOK, "other"]))


@settings(max_examples=5, deadline=None)
@given(st.lists(EVENT, min_size=2, max_size=6), st.data())
def test_silver_does_not_depend_on_how_events_fall_into_runs(spark, events, data):
    import tempfile

    bodies = [
        document(uri, created_at=f"2026-03-0{day}T09:00:00Z", event_type=kind, **source(f"s{n}"))
        for n, (uri, day, kind) in enumerate(events)
    ]
    rows = records(spark, bodies).collect()
    order = data.draw(st.permutations(range(len(rows))))
    cut = data.draw(st.integers(0, len(rows)))
    found = []
    for parts in ([range(len(rows))], [order[:cut], order[cut:]]):
        with tempfile.TemporaryDirectory() as folder:
            layout = Layout(folder)
            for part in parts:
                if part:
                    chosen = spark.createDataFrame([rows[k] for k in part], RECORD)
                    landing.land(chosen, layout.path("landing"))
                    batch.ingest_bronze(spark, layout)
                    batch.extend_silver_bookings(spark, layout)
            found.append(values(batch.silver_bookings(spark, layout)))
    assert found[0] == found[1]


def test_silver_reads_only_new_bronze_and_keeps_the_latest_event(spark, folder):
    layout = Layout(folder)
    newer = document("u/1", created_at="2026-03-05T09:00:00Z", **source("newer"))
    older = document("u/1", created_at="2026-03-04T09:00:00Z", **source("older"))
    for body in (newer, older):
        landing.land(records(spark, [body]), layout.path("landing"))
        batch.ingest_bronze(spark, layout)
        assert batch.extend_silver_bookings(spark, layout) == 1
    assert batch.extend_silver_bookings(spark, layout) == 0
    step_by_step = values(batch.silver_bookings(spark, layout))
    assert values(batch.silver_bookings(spark, layout), "utm_source") == [("newer",)]
    assert batch.refresh_silver_bookings(spark, layout)
    assert values(batch.silver_bookings(spark, layout)) == step_by_step


def test_from_a_folder_of_json_documents_to_the_key_figures(spark, folder):
    layout, day = Layout(folder, landing_format="json"), date(2026, 3, 1)
    inbox = Path(folder, "landing")
    inbox.mkdir()
    bodies = [document("u/1"), document("u/2", event_type=YOUTUBE), document("u/3", event_type="x")]
    for n, body in enumerate(bodies):
        (inbox / f"{n}.json").write_text(json.dumps(body, indent=2))
    (inbox / "bad.json").write_text("{broken\n")
    spend_day(folder, day, [{"channel": "facebook_paid_ads", "date": "2026-03-01", "spend": 8}])
    assert batch.run_batch(spark, layout, day)["bronze"] == 4
    assert batch.quarantine(spark, layout).count() == 1
    arrive(spark, f"{folder}/in", [document("u/9", created_at="2026-03-02T09:00:00Z")])
    stream = file_records(spark, f"{folder}/in")
    start_live(stream, layout.path("live"), f"{folder}/cp", pull_seconds=None).awaitTermination()
    inputs = batch.serving_inputs(spark, layout)
    merged = serving.combined_daily(inputs.daily, inputs.live)
    figures = serving.kpi_summary(merged, inputs.live, inputs.cpb, inputs.meeting_load).first()
    assert (figures.total_bookings, figures.live_bookings, figures.total_spend) == (3, 1, 8.0)


def test_what_the_landing_stream_wrote_is_ingested(spark, folder):
    layout = Layout(folder)
    arrive(spark, f"{folder}/in", [document("u/1")])
    stream = file_records(spark, f"{folder}/in")
    start_landing(stream, layout.path("landing"), f"{folder}/cp").awaitTermination()
    assert batch.ingest_bronze(spark, layout) == 1


def test_a_spend_file_that_comes_again_replaces_what_it_names_and_deletes_nothing(spark, folder):
    layout, day, other = Layout(folder), date(2026, 3, 1), date(2026, 3, 2)
    spend_day(folder, day, [{"channel": c, "date": "2026-03-01", "spend": n} for n, c in enumerate("ab")])
    assert batch.refresh_silver_spends(spark, layout, day) == 2
    spend_day(folder, other, [{"channel": "a", "date": "2026-03-02", "spend": 7}])
    assert batch.refresh_silver_spends(spark, layout, other) == 1
    spend_day(folder, day, [{"channel": "a", "date": "2026-03-01", "spend": 5}])
    assert batch.refresh_silver_spends(spark, layout, day) == 1
    found = values(batch.silver_spends(spark, layout), "channel", "date", "spend")
    assert found == [("a", day, 5.0), ("a", other, 7.0), ("b", day, 1.0)]
    # Without a readable day nothing says that two rows are the same.
    for _ in range(2):
        spend_day(folder, day, [{"channel": "c", "spend": 2}])
        batch.refresh_silver_spends(spark, layout, day)
    assert values(batch.silver_spends(spark, layout).where("date IS NULL"), "spend") == [(2.0,), (2.0,)]


def test_a_repair_of_some_days_deletes_no_booking(spark, folder):
    layout = Layout(folder)
    for n in (1, 2):
        landing.land(records(spark, [document(f"u/{n}")]), layout.path("landing"))
        batch.ingest_bronze(spark, layout)
    assert batch.refresh_silver_bookings(spark, layout)
    everything = values(batch.silver_bookings(spark, layout))
    # Bronze that a later run added, below a later day.
    later = Path(folder, "later")
    bronze = load_declared(spark, layout.path("bronze"), batch.schemas.BRONZE_STORED)
    bronze.where("booking_id = 'u/2'").selectExpr(
        "* EXCEPT (ingest_date, utm_source)", "'newer' utm_source", "date'2999-01-01' ingest_date"
    ).write.partitionBy("readable", "ingest_date").parquet(f"{later}/bronze")
    repaired = Layout(str(later))
    batch._upsert_bookings(repaired, batch.bronze(spark, layout))
    assert batch.refresh_silver_bookings(spark, repaired, since=date(2999, 1, 1))
    assert len(everything) == 2
    assert values(batch.silver_bookings(spark, repaired), "booking_id") == [("u/1",), ("u/2",)]


def test_fields_that_nobody_declared_are_kept_from_the_file_that_has_them(spark, folder):
    layout = Layout(folder)
    landing.land(records(spark, [document("u/1")]), layout.path("landing"))
    batch.ingest_bronze(spark, layout)
    newer = document("u/2", payload={"referrer": {"site": "web"}}) | {"version": 3}
    newer["payload"]["scheduled_event"]["location"] = "room 4"
    landing.land(records(spark, [newer]), layout.path("landing"))
    batch.ingest_bronze(spark, layout)
    read = batch.bronze(spark, layout).selectExpr(
        "booking_id",
        "variant_get(extra, '$.version', 'int') version",
        "variant_get(extra, \"$['payload.referrer'].site\", 'string') site",
        "variant_get(extra, \"$['payload.scheduled_event.location']\", 'string') location",
    )
    assert values(read) == [("u/1", None, None, None), ("u/2", 3, "web", "room 4")]


def test_gold_of_a_run_that_fails_leaves_the_last_one_readable(spark, folder):
    spark.sql("CREATE DATABASE marts")
    layout = Layout(folder, database="marts")
    try:
        landing.land(records(spark, [document("u/1")]), layout.path("landing"))
        batch.run_batch(spark, layout, date(2026, 3, 1))
        before = values(batch.gold_table(spark, layout, "cpb_by_channel"))
        assert values(spark.table("marts.cpb_by_channel")) == before
        spend_day(folder, date(2026, 3, 2), [{"channel": "facebook_paid_ads", "date": "2026-03-02", "spend": 1e30}])
        with pytest.raises(Exception, match="amount out of range"):
            batch.run_batch(spark, layout, date(2026, 3, 2))
        assert values(batch.gold_table(spark, layout, "cpb_by_channel")) == before
        assert values(spark.table("marts.cpb_by_channel")) == before
        spend_day(folder, date(2026, 3, 2), [{"channel": "facebook_paid_ads", "date": "2026-03-02", "spend": 4}])
        for _ in range(3):
            batch.run_batch(spark, layout, date(2026, 3, 2))
        after = values(batch.gold_table(spark, layout, "cpb_by_channel"))
        assert after == [("facebook_paid_ads", 1, 4.0, 4.0)] == values(spark.table("marts.cpb_by_channel"))
        assert len(list(Path(folder, "gold/cpb_by_channel").glob("run=*"))) == 2
        assert published(spark, f"{folder}/gold/none", "a int").isEmpty()
    finally:
        spark.sql("DROP DATABASE marts CASCADE")


def test_bronze_days_before_since_are_not_read(spark, folder):
    layout = Layout(folder)
    landing.land(records(spark, [document("u/1")]), layout.path("landing"))
    batch.ingest_bronze(spark, layout)
    assert not batch.refresh_silver_bookings(spark, layout, since=date(2999, 1, 1))
    assert batch.refresh_silver_bookings(spark, layout, since=date(2020, 1, 1))
