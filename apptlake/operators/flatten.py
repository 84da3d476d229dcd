"""Nested webhook documents to flat, typed rows, for the batch and the live layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, VariantType

from apptlake.functions.channels import CHANNEL_BY_EVENT_TYPE, channel_of, is_paid
from apptlake.functions.times import clock_stamp, instant, written_day
from apptlake.functions.values import first_member
from apptlake.operators.conform import fields_of
from apptlake.schemas import FLAT_COLUMNS, WEBHOOK

CORRUPT = "_corrupt_record"

# Fixed value: the event kind the live layer takes.
CREATED = "invitee.created"

# Text columns of the flat row and where the document holds them.
TEXT_FIELDS = {
    "booking_id": "payload.uri",
    "invitee_email": "payload.email",
    "invitee_first_name": "payload.first_name",
    "invitee_last_name": "payload.last_name",
    "invitee_status": "payload.status",
    "invitee_timezone": "payload.timezone",
    "event_type": "payload.scheduled_event.event_type",
    "event_uri": "payload.scheduled_event.uri",
    "event_name": "payload.scheduled_event.name",
    "event_status": "payload.scheduled_event.status",
    "utm_source": "payload.tracking.utm_source",
    "utm_medium": "payload.tracking.utm_medium",
    "utm_campaign": "payload.tracking.utm_campaign",
    "utm_content": "payload.tracking.utm_content",
    "utm_term": "payload.tracking.utm_term",
}
MEMBERSHIPS = "payload.scheduled_event.event_memberships"


def parse_documents(records: DataFrame, ddl: str = WEBHOOK, body: str = "value") -> DataFrame:
    """Parse JSON text into the declared columns, keeping the other columns of the record.

    A body that cannot be read in full keeps its text in ``_corrupt_record``.
    """
    schema = f"{ddl}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [name for name in records.columns if name != body]
    # A filter moved below a projection would parse the text again for its own use; it stays
    # above a generator, so each body is parsed once.
    document = F.array(F.from_json(F.col(body), schema, options))
    return records.select(*others, F.inline(document))


def declared_names(fields: Sequence[StructField], path: str = "") -> dict[str, list[str]]:
    """The declared fields of a document and of every structure in it, by the structure's path."""
    names = {path: [field.name for field in fields]}
    for field in fields:
        if isinstance(field.dataType, StructType):
            inner = f"{path}.{field.name}" if path else field.name
            names |= declared_names(field.dataType.fields, inner)
    return names


def undeclared_fields(body: Column, ddl: str = WEBHOOK) -> Column:
    """What a JSON text has beyond the declared fields, as a VARIANT; null if there is nothing.

    It is an object whose keys are the fields' paths: a new field of the payload is read by
    ``variant_get(extra, "$['payload.referrer']", 'string')``. The text is parsed once, and a
    structure is looked into one level at a time.
    """
    kind = MapType(StringType(), VariantType())
    declared = declared_names(fields_of(ddl))
    nothing = F.create_map().cast(kind)

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        # Functions on maps do not share what they are given, so each use of an expression would work
        # it out again, from the text on; a variable is worked out once.
        return F.get(F.transform(F.array(value), use), 0)

    def beyond_in(path: str) -> Callable[[Column], Column]:
        return lambda level: beyond(level, path)

    def beyond(level: Column, path: str) -> Column:
        known, prefix = declared[path], f"{path}." if path else ""
        rest = F.map_filter(level, lambda name, _: ~name.isin(known))
        found = [F.transform_keys(rest, lambda name, _: F.concat(F.lit(prefix), name))]
        for name in known:
            if prefix + name in declared:
                inner = F.try_element_at(level, F.lit(name)).try_cast(kind)
                found.append(once(inner, beyond_in(prefix + name)))
        return F.map_concat(*[F.coalesce(part, nothing) for part in found])

    extra = once(F.try_parse_json(body).try_cast(kind), beyond_in(""))
    return once(extra, lambda found: F.when(F.size(found) > 0, F.to_variant_object(found)))


def is_unreadable() -> Column:
    """True of a body that gave no payload. A document with one misfit field is not lost for
    it: the field is null and the rest is used."""
    return F.col(CORRUPT).isNotNull() & F.col("payload").isNull()


def _text(name: str) -> Column:
    return F.col(TEXT_FIELDS[name]).alias(name)


def bronze_rows(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The flat columns of the bronze table; ``keep`` names record columns to carry along.

    Only names and types change here: no row is filtered, cleaned or de-duplicated.
    """
    columns = {name: F.col(place) for name, place in TEXT_FIELDS.items()}
    columns |= {
        "booking_date": instant(F.col("created_at")),
        "start_time": instant(F.col("payload.scheduled_event.start_time")),
        "end_time": instant(F.col("payload.scheduled_event.end_time")),
        "host_email": first_member(F.col(MEMBERSHIPS), "user_email"),
        "host_name": first_member(F.col(MEMBERSHIPS), "user_name"),
        "was_rescheduled": F.col("payload.rescheduled").try_cast("boolean"),
        "questions_and_answers": F.col("payload.questions_and_answers"),
    }
    return documents.select(*[columns[name].alias(name) for name in FLAT_COLUMNS], *keep)


def with_lineage(rows: DataFrame, source_file: Column) -> DataFrame:
    """Add when and from which file a row came in; ``ingest_date`` partitions the table."""
    return rows.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": source_file,
            "ingest_date": F.current_date(),
        }
    )


def live_rows(
    documents: DataFrame,
    rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Live items: created events of paid channels, with times left as ISO text.

    Works alike on a static and a streaming frame.
    """
    return (
        documents.where(F.col("event") == CREATED)
        .select(
            _text("booking_id"),
            written_day(F.col("created_at")).cast("string").alias("booking_date"),
            _text("event_type"),
            F.col("payload.scheduled_event.start_time").alias("start_time"),
            F.col("payload.scheduled_event.end_time").alias("end_time"),
            first_member(F.col(MEMBERSHIPS), "user_email").alias("host_email"),
            first_member(F.col(MEMBERSHIPS), "user_name").alias("host_name"),
            _text("utm_source"),
            channel_of(F.col(TEXT_FIELDS["event_type"]), rules).alias("channel"),
            clock_stamp().alias("ingested_at"),
            *keep,
        )
        .where(is_paid(F.col("channel"), rules))
    )


def item_documents(items: DataFrame) -> DataFrame:
    """One JSON document per live item, null attributes left out."""
    return items.select("booking_id", F.to_json(F.struct(*items.columns)).alias("item"))
