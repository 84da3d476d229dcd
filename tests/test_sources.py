from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from apptlake import schemas, session
from apptlake.operators.flatten import bronze_rows
from apptlake.sources import files, landing
from apptlake.sources.documents import read_documents, read_spend, read_spend_files, spend_file
from apptlake.sources.tables import (
    append,
    load_if_present,
    load_or_empty,
    publish,
    published,
    read_table,
    stored,
)
from samples import document, records, values

DAY = date(2026, 3, 1)


def test_one_document_per_file_over_several_lines(spark, tmp_path):
    for day, name in (("2026-03-01", "a"), ("2026-03-01", "b"), ("2026-03-02", "c")):
        place = tmp_path / f"date={day}"
        place.mkdir(exist_ok=True)
        text = json.dumps(document(f"u/{name}", memberships=[]), indent=2)
        (place / f"{name}.json").write_text(text)
    rows = bronze_rows(read_documents(spark, str(tmp_path)), keep=("date",))
    assert values(rows, "booking_id", "host_email", F.col("date").cast("string")) == [
        ("u/a", None, "2026-03-01"),
        ("u/b", None, "2026-03-01"),
        ("u/c", None, "2026-03-02"),
    ]


def test_an_empty_folder_of_documents_gives_no_rows(spark, folder):
    assert read_documents(spark, folder).isEmpty()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []),
        ('{"channel": "fb", "date": "2026-03-01", "spend": 3}', [("fb", "2026-03-01", 3.0)]),
        (
            '[{"channel": "fb", "spend": 3.5},\n {"channel": "yt", "date": "x", "spend": null}]',
            [("fb", None, 3.5), ("yt", "x", None)],
        ),
    ],
)
def test_spend_file_absent_one_object_or_list(spark, folder, text, want):
    if text is not None:
        Path(spend_file(folder, DAY)).write_text(text)
    spend = read_spend(spark, folder, DAY)
    assert spend.dtypes == [("channel", "string"), ("date", "string"), ("spend", "double")]
    assert values(spend) == want


def test_load_or_empty(spark, folder):
    ddl = schemas.GOLD_BOOKINGS_BY_SOURCE_DAILY
    missing = load_or_empty(spark, f"{folder}/none", ddl)
    assert missing.count() == 0 and missing.columns[0] == "booking_date"
    Path(folder, "bare").mkdir()
    assert load_or_empty(spark, f"{folder}/bare", ddl).isEmpty()
    spark.sql("select date'2026-03-01' booking_date, 3L booking_count").write.parquet(f"{folder}/t")
    assert values(load_or_empty(spark, f"{folder}/t", ddl)) == [(DAY, None, 3)]
    Path(folder, "bad").mkdir()
    Path(folder, "bad", "x.parquet").write_text("no parquet")
    assert load_or_empty(spark, f"{folder}/bad", ddl).isEmpty()
    with pytest.raises(Exception, match="CANNOT_READ_FILE_FOOTER"):
        load_if_present(spark, f"{folder}/bad", ddl)


def test_append_partitions_counts_and_evolves(spark, folder):
    first = spark.sql("select 1 a, date'2026-03-01' ingest_date")
    second = spark.sql("select 2 a, 'new' b, date'2026-03-02' ingest_date")
    assert append(first, folder, "ingest_date") == 1
    assert append(second, folder, "ingest_date") == 1
    table = read_table(spark, folder, merge=True)
    assert values(table, "a", "b") == [(1, None), (2, "new")]
    assert (Path(folder) / "ingest_date=2026-03-02").is_dir()


def test_appending_nothing_adds_no_rows(spark, folder):
    assert append(spark.range(0).selectExpr("id", "current_date() d"), folder, "d") == 0
    assert append(spark.range(3).selectExpr("id", "current_date() d"), folder, "d") == 3
    assert read_table(spark, folder).count() == 3


def test_publish_replaces_the_table_and_keeps_the_run_before(spark, folder):
    assert published(spark, folder, "id long").isEmpty()
    assert publish(spark.range(5), folder) == 5
    reader = published(spark, folder, "id long")
    assert publish(spark.range(2), folder) == 2
    assert published(spark, folder, "id long").count() == 2 and reader.count() == 5
    with pytest.raises(Exception, match="half way"):
        publish(spark.range(9).selectExpr("if(id = 8, raise_error('half way'), id) id"), folder)
    assert published(spark, folder, "id long").count() == 2
    assert publish(spark.range(3), folder) == 3
    assert published(spark, folder, "id long, more string").columns == ["id", "more"]
    assert len(list(Path(folder).glob("run=*"))) == 2


def test_stored_frame_equals_its_source(spark, folder):
    df = spark.range(5).selectExpr("id", "string(id) s")
    assert values(stored(df, folder)) == values(df)


def test_landing_places_bodies_and_reads_the_later_of_two(spark, folder):
    bodies = [
        document("https://x/inv/1", created_at="2026-03-01T10:00:00Z"),
        document("https://x/inv/2", created_at="2026-03-02T10:00:00Z"),
        document("https://x/inv/1", created_at="2026-03-01T11:00:00Z", event="invitee.canceled"),
        document("https://x/inv/1", created_at="2026-03-03T11:00:00Z"),
    ]
    assert landing.land(records(spark, bodies), folder) == 4
    assert sorted(files.child_names(spark, folder))[-3:] == [
        "date=2026-03-01",
        "date=2026-03-02",
        "date=2026-03-03",
    ]
    kept = landing.latest_bodies(landing.stored(spark, folder))
    assert values(kept, "date", "invitee_id", "sequence") == [
        ("2026-03-01", "1", 2),
        ("2026-03-02", "2", 1),
        ("2026-03-03", "1", 3),
    ]
    body = kept.where("sequence = 2").first().value
    assert json.loads(body) == bodies[2]


def test_landing_is_pruned_by_day(spark, folder):
    landing.land(records(spark, [document()]), folder)
    scan = landing.stored(spark, folder).where("date = '2026-03-01'")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_scratch_folder_comes_from_the_session(spark, folder, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return {"spark.checkpoint.dir": f"{folder}/shared/"}.get(name, default)

    class Session:
        conf = Conf()

    assert session.scratch_root(Session()) == f"{folder}/shared"


def test_scratch_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://somewhere"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_shuffles_grow_with_the_input_and_leave_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_shuffles(spark, 1) as partitions:
        assert partitions == int(before)
    with session.sized_shuffles(spark, 100 * 2**40) as partitions:
        assert partitions == 409600 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_bodies_without_day_or_id_all_stay(spark, folder):
    landing.land(records(spark, [document(None), "{broken", "{broken", document("u/1")]), folder)
    assert landing.latest_bodies(landing.stored(spark, folder)).count() == 4


@pytest.mark.parametrize(
    "text",
    [
        '[{"channel": "fb", "date": "2026-03-01", "spend": 3}, {"chan',
        '{"channel": "fb", "date": "2026-03-01", "spend": "many"}',
        '{"cost": {"fb": 3}}',
    ],
)
def test_spend_that_cannot_be_read_fails(spark, folder, text):
    Path(spend_file(folder, DAY)).write_text(text)
    with pytest.raises(Exception, match="spend record that cannot be read"):
        read_spend(spark, folder, DAY).collect()


def test_amounts_may_be_written_as_text(spark, folder):
    Path(spend_file(folder, DAY)).write_text('{"channel": "fb", "date": "d", "spend": "8.5"}')
    assert values(read_spend(spark, folder, DAY)) == [("fb", "d", 8.5)]


def test_amounts_read_the_same_however_they_are_written(spark, folder):
    amounts = ["12.5", '"12.5"', "7", "1e3", "-0.25", "123456789012345678901234567890", "NaN", "null"]
    text = ",".join(f'{{"channel": "c{n}", "date": "2024-01-01", "spend": {a}}}' for n, a in enumerate(amounts))
    Path(folder, "spend.json").write_text(f"[{text}]")
    rows = {r.channel: r.spend for r in read_spend_files(spark, folder).collect()}
    assert [repr(rows[f"c{n}"]) for n in range(8)] == [
        "12.5", "12.5", "7.0", "1000.0", "-0.25", "1.2345678901234568e+29", "nan", "None"
    ]


@pytest.mark.parametrize("amount", ["true", '{"a": 1}', "[1]", '"much"'])
def test_amounts_that_are_no_numbers_fail(spark, folder, amount):
    Path(folder, "spend.json").write_text(f'{{"channel": "c", "date": "2024-01-01", "spend": {amount}}}')
    with pytest.raises(Exception, match="cannot be read"):
        read_spend_files(spark, folder).collect()


def test_numbers_are_not_read_from_the_file_again(spark, folder):
    """A number that is declared as text would be, one seek for each."""
    Path(folder, "spend.json").write_text('{"channel": "c", "date": "2024-01-01", "spend": 1.5}')
    read = read_spend_files(spark, folder)
    scan = read._jdf.queryExecution().analyzed().collectLeaves().head()
    assert "variant" in scan.schema().toDDL().lower()
    assert read.schema["spend"].dataType.simpleString() == "double"
