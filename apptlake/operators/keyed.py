"""Keyed tables: one row per key on disk, upserted by buckets of keys.

Plain Parquet has no MERGE. Here a table lies in folders by a hash of its key, and an upsert reads and
rewrites only the buckets that its rows fall in, under Spark's dynamic partition overwrite. Rows that
match by key are replaced, others are inserted, and none is deleted; readers take the table as it is.
How many buckets a table has is in its folder names, so that every run goes by the same number.

One writer at a time. A batch that runs again ends where it ended before. A driver that dies while
folders are swapped leaves the new one below ``.spark-staging``; buckets are swapped one after the
other. Where a table format with row-level MERGE is at hand, ``merge_into_table`` does the same in one
commit; on stores whose rename is not atomic (most object stores) such a format is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apptlake.session import scratch_path
from apptlake.sources import files
from apptlake.sources.tables import counted, load_declared, stored

#: Buckets of a new table. One is rewritten as a whole, so a table of terabytes wants thousands.
BUCKETS = 64
NUMBER, BUCKET = "buckets", "bucket"
#: Rows of a bucket that one task ranks and writes; of a larger one several do.
ROWS_PER_TASK = 300_000
SLICE = "_slice"


def keyless(keys: Sequence[str]) -> Column:
    return F.greatest(*[F.col(key).isNull() for key in keys], F.lit(False))


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """How many buckets a table was made with; None before its first rows."""
    names = (name.split("=") for name in files.child_names(spark, path))
    return next((int(name[1]) for name in names if name[0] == NUMBER), None)


def in_buckets(source: DataFrame, keys: Sequence[str], count: int, null_safe: bool = True) -> DataFrame:
    """Rows with the two columns that place them; rows that match nothing may lie anywhere, and are
    spread by all their columns."""
    place = F.xxhash64(*keys)
    if not null_safe:
        place = F.when(keyless(keys), F.xxhash64(*source.columns)).otherwise(place)
    bucket = F.pmod(place, F.lit(count)).cast("int")
    return source.withColumn(NUMBER, F.lit(count)).withColumn(BUCKET, bucket)


def current(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The table as it is; a missing one is empty."""
    return load_declared(spark, path, f"{ddl}, {NUMBER} int, {BUCKET} int").drop(NUMBER, BUCKET)


def _one_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[Column], null_safe: bool) -> DataFrame:
    """Of each key the first row by the order, then the new one. Fails on a key with two new rows.

    Both sides come with one row per key, so a group has two rows at most.
    """
    alone = F.when(keyless(keys), F.xxhash64(*rows.columns)) if not null_safe else F.lit(None)
    alike = Window.partitionBy(BUCKET, SLICE, *keys, alone)
    message = F.concat(F.lit("several source rows for one key: "), F.to_json(F.struct(*keys)))
    repeated = F.when(F.col("_news") > 1, F.raise_error(message).cast("boolean"))
    first = F.col("_nth") == 1
    kept = F.coalesce(repeated, first)
    if not null_safe:
        kept = keyless(keys) | kept
    ranked = rows.withColumn("_nth", F.row_number().over(alike.orderBy(*order_by, F.desc("_new"))))
    return ranked.withColumn("_news", F.sum("_new").over(alike)).where(kept).drop("_new", "_nth", "_news", SLICE)


def _dealt(both: DataFrame, keys: Sequence[str], parts: int, count: int, null_safe: bool) -> DataFrame:
    """Rows of ``parts`` buckets, ``count`` in all, in tasks of some ``ROWS_PER_TASK``, however few the
    buckets are: a large bucket is dealt in slices of its keys, each a file."""
    slices = -(-count // (parts * ROWS_PER_TASK)) or 1
    place = F.xxhash64(*keys)
    if not null_safe:
        place = F.when(keyless(keys), F.xxhash64(*both.columns)).otherwise(place)
    # The bucket is a remainder of the same hash, so slices go by its other half.
    sliced = both.withColumn(SLICE, F.pmod(F.shiftright(place, 32), F.lit(slices)))
    if slices == 1:
        return sliced.repartition(BUCKET)
    # Some spare partitions, so that few slices meet in one.
    return sliced.repartition(2 * parts * slices, BUCKET, SLICE)


def _overwrite(rows: DataFrame, path: str, *partitions: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    buckets: int = BUCKETS,
    null_safe: bool = False,
) -> int:
    """Replace rows that match by key, insert the others; returns how many source rows there were.

    The first upsert makes the table. With ``order_by`` a source row replaces another only if it is
    first by that order, so that what comes late cannot undo what is newer. A row with a null key
    matches nothing and is inserted, as in MERGE, unless ``null_safe``. A key that occurs twice in
    the source fails the job.
    """
    spark, ddl = source.sparkSession, source.schema.toDDL()
    made = bucket_count(spark, path)
    scratch = scratch_path(spark, "upsert")
    rows = stored(in_buckets(source, keys, made or buckets, null_safe), scratch)
    news = {row[0]: row["count"] for row in rows.groupBy(BUCKET).count().collect()}
    seen = count = sum(news.values())
    if news:
        both = rows.withColumn("_new", F.lit(1))
        if made is not None:
            old = load_declared(spark, path, f"{ddl}, {NUMBER} int, {BUCKET} int").where(F.col(BUCKET).isin([*news]))
            count += old.count()
            both = old.withColumn("_new", F.lit(0)).unionByName(both)
        both = _dealt(both, keys, len(news), count, null_safe)
        _overwrite(_one_per_key(both, keys, order_by, null_safe), path, NUMBER, BUCKET)
    files.delete(spark, scratch)
    return seen


def upsert_within(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    within: str,
    earlier: str,
    order_by: Sequence[Column],
    buckets: int,
) -> None:
    """The same for a table that lies by a column ``within`` (a day) above its buckets.

    A row may move to another day. ``earlier`` names an array column of the days that its key ever
    had, which is not stored: only the buckets of these days are read and rewritten. Every folder
    rewritten gets a row without a key to hold its place, as dynamic overwrite replaces no folder
    that nothing is written to; readers leave such rows out, and source rows without a key go.
    """
    spark = source.sparkSession
    made = bucket_count(spark, path)
    scratch = scratch_path(spark, "upsert")
    rows = stored(in_buckets(source.where(~keyless(keys)), keys, made or buckets), scratch)
    count = rows.count()
    both = rows.drop(earlier).withColumn("_new", F.lit(1))
    if count and made is None:
        both = _dealt(both, keys, buckets, count, False)
        _overwrite(_one_per_key(both, keys, order_by, False), path, NUMBER, within, BUCKET)
    elif count:
        days = F.explode(F.array_union(F.array(within), earlier)).alias(within)
        touched = rows.select(days, NUMBER, BUCKET).distinct()
        places = touched.collect()
        parts = {place[BUCKET] for place in places}
        ddl = rows.drop(earlier).schema.toDDL()
        old = load_declared(spark, path, ddl).where(
            F.col(within).isin(sorted({p[0] for p in places})) & F.col(BUCKET).isin(sorted(parts))
        )
        old = old.where(~keyless(keys)).join(touched, [within, NUMBER, BUCKET], "left_semi")
        count += old.count()
        both = _dealt(old.withColumn("_new", F.lit(0)).unionByName(both), keys, len(parts), count, False)
        merged = _one_per_key(both, keys, order_by, False)
        holders = spark.createDataFrame(places).select(within, F.col(NUMBER).cast("int"), F.col(BUCKET).cast("int"))
        holders = holders.repartition(BUCKET)
        _overwrite(merged.unionByName(holders, allowMissingColumns=True), path, NUMBER, within, BUCKET)
    files.delete(spark, scratch)


def append_new(
    source: DataFrame, path: str, keys: Sequence[str], version: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Append rows whose key has none stored that is as new or newer by ``version``.

    A stream's batch meets what is stored instead of carrying state: replays go, whenever they come,
    and nothing else does. Only keys and versions of the batch's buckets are read. Rows without a key
    are told apart by all their columns. The source has one row per key.
    """
    spark = source.sparkSession
    count = bucket_count(spark, path) or buckets
    known = F.coalesce(F.concat_ws("/", *keys), F.lit("")) if len(keys) > 1 else F.col(keys[0])
    alone = F.concat(F.lit("no key/"), F.hex(F.xxhash64(*source.columns)))
    rows = source.withColumn("_known", F.when(keyless(keys), alone).otherwise(known))
    scratch = scratch_path(spark, "append")
    rows = stored(in_buckets(rows, ["_known"], count), scratch)
    touched = [row[0] for row in rows.select(BUCKET).distinct().collect()]
    if touched:
        old = load_declared(spark, path, rows.schema.toDDL()).where(F.col(BUCKET).isin(touched))
        newest = old.groupBy("_known").agg(F.max(F.struct(*version)).alias("_newest"))
        stale = rows.join(newest, "_known").where(F.struct(*version) <= F.col("_newest"))
        fresh = rows.join(stale.select("_known"), "_known", "left_anti")
        fresh.write.mode("append").partitionBy(NUMBER, BUCKET).parquet(path)
    files.delete(spark, scratch)


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str]) -> int:
    """The same upsert on a catalog table whose format has row-level MERGE (Delta, Iceberg); returns
    how many source rows there were."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    rows, seen = counted(source, f"merge {table}")
    (
        rows.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
    return seen.get["rows"]
