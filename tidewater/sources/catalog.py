"""Make stored tables available by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from ..operators.masking import MASKS, mask_sql
from ..operators.store import TableStore
from ..schemas import CUSTOMER_SENSITIVE, TableSpec


def register_tables(store: TableStore, specs: Iterable[TableSpec]) -> list[str]:
    """Views over the stored tables, one database per layer.

    A view always shows the table's last committed write, also while the next one is under way. The sensitive
    table is refused: a plain view would show what its masks hide.
    """
    specs = list(specs)
    if any(spec.name == CUSTOMER_SENSITIVE.name for spec in specs):
        raise PermissionError("read the sensitive table with read_sensitive, which masks it")
    names = []
    for spec in specs:
        name = f"{spec.layer}.{spec.name}"
        columns = ", ".join(f"`{c}`" for c in spec.columns.names)
        store.spark.sql(f"CREATE DATABASE IF NOT EXISTS {spec.layer}")
        store.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {store.table_name(spec)}")
        names.append(name)
    return names


ROLE_VARIABLE = "tidewater_role"


def use_role(spark: SparkSession, role: str) -> None:
    """Set the role that masked views go by from now on in this session."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT ''")
    spark.sql(f"SET VAR {ROLE_VARIABLE} = :role", {"role": role})


def register_masked(store: TableStore, spec: TableSpec = CUSTOMER_SENSITIVE) -> str:
    """Make a sensitive table readable by name, masked for the session's role of the moment.

    The view is SQL text with the masks in it, so each query that names it is masked by the role that
    holds when the query is analysed; without ``use_role`` everything is hidden. Whoever may set the
    variable chooses the role: set it where sessions are handed out. Spark refuses session variables in permanent
    views, so the view belongs to the session, as the role does.
    """
    spark = store.spark
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT ''")
    columns = ", ".join(f"{mask_sql(c, ROLE_VARIABLE)} AS {c}" if c in MASKS else c for c in spec.columns.names)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {spec.name} AS SELECT {columns} FROM {store.table_name(spec)}")
    return spec.name
