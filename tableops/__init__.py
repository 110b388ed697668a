"""Day-to-day table work as Spark jobs: run SQL, write, update, swap, rebuild, backfill."""

from tableops.functions.columns import (
    NULL_TOKENS,
    apply_schema,
    cast_temporal,
    normalize_nulls,
    result_schema,
)
from tableops.functions.types import spark_type
from tableops.operators.compact import compact_table
from tableops.operators.rebuild import rebuild_table
from tableops.operators.swap import recover_table, swap_tables
from tableops.operators.update import finish_update, update_table
from tableops.operators.write import bulk_insert, create_from_data, save_table
from tableops.plans.backfill import backfill_daily, backfill_range, daily_slices
from tableops.plans.script import run_script
from tableops.sources.catalog import table_schema
from tableops.sources.query import run_sql, run_sql_pandas

__all__ = [
    "NULL_TOKENS",
    "apply_schema",
    "backfill_daily",
    "backfill_range",
    "bulk_insert",
    "cast_temporal",
    "compact_table",
    "create_from_data",
    "daily_slices",
    "finish_update",
    "normalize_nulls",
    "rebuild_table",
    "recover_table",
    "result_schema",
    "run_script",
    "run_sql",
    "run_sql_pandas",
    "save_table",
    "spark_type",
    "swap_tables",
    "table_schema",
    "update_table",
]
