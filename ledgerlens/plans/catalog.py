"""The warehouse for SQL users: catalog views over its published tables (S12,
V1).

Each table is a view that names the published files, so a user's SQL reads
one consistent state and never a half load; ``publish_views`` replaces the
views after a load, each in one catalog operation. In a catalog that is kept
(a metastore) they are there for every session; in Spark's own they last as
long as the session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlens.plans import dimension, warehouse
from ledgerlens.schemas import SCREENING_COLUMNS, WAREHOUSE_TABLES
from ledgerlens.sources import lake

DATABASE = "ledgerlens"
LATEST = "v_latest_screening"


def _name(text: str) -> str:
    return f"`{text.replace('`', '``')}`"


def _selects(spark: SparkSession, root: str, table: str) -> list[str]:
    """A SELECT for each published folder of a table, with its declared
    columns and types."""
    schema = WAREHOUSE_TABLES[table]
    folder = warehouse.table_path(root, table)

    def select(path: str, fixed: dict[str, str]) -> str:
        columns = ", ".join(
            f"CAST({fixed.get(f.name, _name(f.name))} AS {f.dataType.simpleString()}) AS {_name(f.name)}" for f in schema.fields
        )
        return f"SELECT {columns} FROM parquet.{_name(path)}"

    if table == warehouse.FACT:
        dates = lake.run_dates(spark, root, warehouse.LAYER, table)
        paths = {d: lake.current_version(spark, lake.partition_path(root, warehouse.LAYER, table, d)) for d in dates}
        return [select(p, {"run_date": f"DATE '{d}'"}) for d, p in paths.items() if p]
    if table == warehouse.COMPANY:
        return [select(p, {}) for p in dimension.paths(spark, folder)]
    current = lake.current_version(spark, folder)
    return [select(current, {})] if current else []


def publish_views(
    spark: SparkSession, root: str, database: str = DATABASE, tables: tuple[str, ...] = tuple(WAREHOUSE_TABLES)
) -> list[str]:
    """Create or replace a view for each table, and the latest screening:
    the newest run date with each company's listing_date, criteria_passed
    then roe descending, NULLs first (N5). Returns the views' names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    made = []
    for table in tables:
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_name(f.name)}" for f in WAREHOUSE_TABLES[table].fields)
        body = " UNION ALL ".join(_selects(spark, root, table)) or f"SELECT {empty} WHERE false"
        made.append(f"{_name(database)}.{_name(table)}")
        spark.sql(f"CREATE OR REPLACE VIEW {made[-1]} AS {body}")
    newest = lake.newest_run_date(spark, root, warehouse.LAYER, warehouse.FACT)
    columns = ", ".join(f"s.{c}" for c in SCREENING_COLUMNS)
    fact, company = (f"{_name(database)}.{_name(t)}" for t in (warehouse.FACT, warehouse.COMPANY))
    made.append(f"{_name(database)}.{LATEST}")
    # The run date is written into the view: only its files are opened.
    spark.sql(
        f"CREATE OR REPLACE VIEW {made[-1]} AS SELECT {columns}, c.listing_date FROM {fact} s JOIN {company} c ON c.ticker = s.ticker "
        f"WHERE {f'''s.run_date = DATE '{newest}' ''' if newest else 'false'} "
        "ORDER BY s.criteria_passed DESC NULLS FIRST, s.roe DESC NULLS FIRST"
    )
    return made
