"""Daily backfill: day by day from a template, or a whole range in one job."""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, StringType

from tableops.functions.names import quoted
from tableops.operators.counted import counted_write, dynamic_overwrite, rebalanced
from tableops.operators.swap import recover_table
from tableops.plans.script import run_script
from tableops.sources.catalog import require_table, table_name
from tableops.sources.query import run_sql

# The day placeholders of a template, for start (included) and stop (not).
START_TEXT = "$START_TIME"
STOP_TEXT = "$STOP_TIME"
_DAY = dt.timedelta(days=1)


def backfill_daily(
    spark: SparkSession,
    template: str,
    start: dt.date | str,
    stop: dt.date | str,
    into: str | None = None,
    day_col: str = "day",
    ledger: str | None = None,
    job: str | None = None,
    source: str | None = None,
    source_ts: str = "ts",
) -> dict[str, Any]:
    """Run a template once for each day of [start, stop), in order, stopping at a failure.

    The template is a script. Its day is bound to ``:start_time`` and the next day to
    ``:stop_time``, as dates; the texts ``$START_TIME`` and ``$STOP_TIME`` are replaced by
    the same days. To be safe to run again the script should overwrite its day, partition
    named. With ``into`` the template is one query, without the day column, and its result
    overwrites partition ``day_col`` of that table, also when there are no rows.

    ``ledger`` names a table, made if it is missing, where each day that is done is recorded with
    a hash of the template, under ``job`` (by default the name of ``into``). Days recorded last
    with the same template are left out, so a run that was cut off goes on where it ended, and a
    changed template does all days again. With ``source``, a table with the time column
    ``source_ts``, a day is also done again when its rows have changed since: a count and a sum
    of row hashes for each day, found by one job for the whole range, are recorded too. Days in
    the ledger that were not done again are returned as ``'skipped'``.

    Returns ``{'succeeded': True, 'days': [..]}``, or ``{'succeeded': False, 'days': done,
    'failed_day': .., 'error': .., 'sqls': ..}``.
    """
    target = None if into is None else table_name(spark, into)
    if target is not None:
        recover_table(spark, target)
        require_table(spark, target)
    days, kept = _days(start, stop), {}
    book = None
    if ledger is not None:
        book = Ledger(spark, ledger, job or (target and str(target)), f"{template}\n{target}\n{day_col}")
        sums = {} if source is None else day_checksums(spark.table(source), source_ts, start, stop)
        kept = {"skipped": [d for d in days if book.holds(d, sums.get(d, ""))]}
        days = [d for d in days if d not in set(kept["skipped"])]
    done: list[dt.date] = []
    for day in days:
        filled = template.replace(START_TEXT, day.isoformat())
        filled = filled.replace(STOP_TEXT, (day + _DAY).isoformat())
        script: str | list[str] = filled
        if target is not None:
            query = filled.rstrip().rstrip(";")
            script = [f"INSERT OVERWRITE TABLE {target} {_partition(day_col, day)} {query}"]
        result = run_script(spark, script, {"start_time": day, "stop_time": day + _DAY})
        if not result["succeeded"]:
            return {**result, "days": done, "failed_day": day, **kept}
        if book is not None:
            # after the day itself: a run lost in between does the day again
            book.record(day, sums.get(day, ""))
        done.append(day)
    return {"succeeded": True, "days": done, **kept}


class Ledger:
    """Days that a job has done, in a table that only grows; the last record of a day counts."""

    def __init__(self, spark: SparkSession, name: str, job: str | None, template: str) -> None:
        if not job:
            raise ValueError("A ledger needs the name of the job")
        self.spark, self.name, self.job = spark, table_name(spark, name), job
        self.template = hashlib.sha256(template.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} "
            "(job STRING, day DATE, template STRING, source STRING, recorded BIGINT) USING parquet"
        )
        # one row for each day of the job
        last = F.max_by(F.struct("template", "source"), "recorded").alias("last")
        rows = spark.table(str(self.name)).where(F.col("job") == job).groupBy("day").agg(last)
        self.done = {r["day"]: tuple(r["last"]) for r in rows.collect()}

    def holds(self, day: dt.date, source: str) -> bool:
        return self.done.get(day) == (self.template, source)

    def record(self, day: dt.date, source: str) -> None:
        self.spark.sql(
            f"INSERT INTO {self.name} VALUES (:job, :day, :template, :source, :recorded)",
            {"job": self.job, "day": day, "template": self.template, "source": source,
             "recorded": time.time_ns()},
        )
        self.done[day] = (self.template, source)


def day_checksums(
    df: DataFrame, ts: str, start: dt.date | str, stop: dt.date | str
) -> dict[dt.date, str]:
    """For each day of [start, stop) that has rows, their count and a sum of hashes of them.

    The sum doesn't depend on the order of rows or files, and counts repeated rows. One grouping,
    combined before the shuffle; the result has a row for each day.
    """
    at = F.col(quoted(ts))
    inside = df.where((at >= F.lit(_date(start))) & (at < F.lit(_date(stop))))
    # maps have no hash of their own; their JSON lists the entries as they are held
    columns = [
        F.to_json(quoted(f.name)) if isinstance(f.dataType, MapType) else F.col(quoted(f.name))
        for f in df.schema
    ]
    hashed = F.xxhash64(*columns, *[c.isNull() for c in columns]).cast("decimal(38,0)")
    rows = inside.groupBy(F.to_date(at).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("hashes")
    )
    return {r["day"]: f"{r['n']}:{r['hashes']}" for r in rows.collect()}


def backfill_range(
    spark: SparkSession,
    query: str,
    start: dt.date | str,
    stop: dt.date | str,
    into: str,
    day_col: str = "day",
) -> int:
    """Overwrite the days of [start, stop) from one query in one job; return the rows written.

    ``query`` yields the columns of ``into``, the day last, for the whole range, which is
    bound to ``:start_time`` and ``:stop_time``. Days of the range without rows end empty,
    other days are untouched, and a row outside the range fails the job. The table is
    partitioned by the day column alone, a date or its ISO text.
    """
    days = _days(start, stop)
    if not days:
        return 0
    target = table_name(spark, into)
    recover_table(spark, target)
    info = require_table(spark, target)
    parts = info.get("partition_columns") or []
    if [p.lower() for p in parts] != [day_col.lower()]:
        raise ValueError(f"{target} must be partitioned by {day_col} alone")
    day_col = parts[0]
    schema = spark.table(str(target)).schema
    if not isinstance(schema[day_col].dataType, (DateType, StringType)):
        raise ValueError(f"{day_col} must be a date or its text: {schema[day_col].dataType}")

    bounds = {"start_time": days[0], "stop_time": days[-1] + _DAY}
    rows = run_sql(spark, query, bounds, schema=schema)
    day = F.col(quoted(day_col))
    date = day.cast("date")
    inside = (date >= F.lit(bounds["start_time"])) & (date < F.lit(bounds["stop_time"]))
    stray = F.coalesce(day.cast("string"), F.lit("NULL"))
    refused = F.raise_error(F.concat(F.lit("Day outside the range: "), stray))
    checked = F.when(inside, day).otherwise(refused).alias(day_col)
    rows = rebalanced(rows.select(*map(quoted, schema.names[:-1]), checked), [day_col])
    with dynamic_overwrite(spark):
        seen = counted_write(
            rows,
            lambda out: out.write.insertInto(str(target), overwrite=True),
            {"days": F.collect_set(date)},
        )
    spark.catalog.refreshTable(str(target))
    stale = sorted(set(days) - set(seen["days"]))
    if info.get("type") == "MANAGED":
        _drop_days(spark, str(target), day_col, stale)
    else:
        _empty_days(spark, str(target), day_col, stale)
    return seen["rows"]


def daily_slices(
    df: DataFrame,
    ts: str,
    start: dt.date | str,
    stop: dt.date | str,
    *aggregates: Column,
    day_col: str = "day",
) -> DataFrame:
    """Aggregate each day of [start, stop) in one plan: one row per day, empty days included.

    A row belongs to the day with ``day <= ts < day + 1``, so this is a grouping and no
    range join. A day without rows gets what the aggregates give over no rows.
    """
    days = _days(start, stop)
    lower, upper = F.lit(_date(start)), F.lit(_date(stop))
    at = F.col(quoted(ts))
    inside = df.where((at >= lower) & (at < upper))
    daily = inside.groupBy(F.to_date(at).alias(day_col)).agg(*aggregates)
    names = daily.columns[1:]
    over_nothing = df.limit(0).agg(*aggregates).first()  # folded to a constant, reads nothing
    calendar = df.sparkSession.range(len(days)).select(
        F.date_add(lower, F.col("id").cast("int")).alias(day_col)
    )
    joined = calendar.join(daily.withColumn("___seen", F.lit(True)), day_col, "left")

    def value(position: int, name: str) -> Column:
        empty = over_nothing[position]
        if empty is None:
            return F.col(quoted(name))
        default = F.lit(empty).cast(daily.schema[name].dataType)
        return F.when(F.col("___seen"), F.col(quoted(name))).otherwise(default).alias(name)

    return joined.select(day_col, *[value(i, n) for i, n in enumerate(names)])


def _date(day: dt.date | str) -> dt.date:
    if isinstance(day, dt.datetime):
        raise ValueError(f"Expected a day, got a time: {day}")
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def _days(start: dt.date | str, stop: dt.date | str) -> list[dt.date]:
    first, end = _date(start), _date(stop)
    return [first + i * _DAY for i in range((end - first).days)]


def _partition(day_col: str, day: dt.date) -> str:
    return f"PARTITION ({quoted(day_col)} = DATE '{day.isoformat()}')"


def _drop_days(spark: SparkSession, target: str, day_col: str, days: list[dt.date]) -> None:
    """Drop the days' partitions, with their files, in one statement."""
    if days:
        listed = ", ".join(_partition(day_col, day) for day in days)
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {listed}")


def _empty_days(spark: SparkSession, target: str, day_col: str, days: list[dt.date]) -> None:
    """Overwrite with no rows those of the days that exist as partitions.

    For external tables, where dropping a partition would leave its files.
    """
    texts = {day.isoformat(): day for day in days}
    # The day alone: the catalog may escape the column's name.
    value = F.substring_index("partition", "=", -1).alias("day")
    listed = spark.sql(f"SHOW PARTITIONS {target}").select(value).where(F.col("day").isin(list(texts)))
    nulls = ", ".join("NULL" for _ in spark.table(target).columns[:-1])
    for row in listed.toLocalIterator():
        spark.sql(
            f"INSERT OVERWRITE TABLE {target} {_partition(day_col, texts[row.day])} "
            f"SELECT {nulls} WHERE false"
        )
