"""Publish tables to a relational database, through Spark's JDBC sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from vanescope.sources.database import read_query

#: Characters of a name that databases keep.
_NAME_LENGTH = 63


def staging_name(table: str, mark: str) -> str:
    """Name of a table beside ``table``, quoted as that is and told apart by ``mark``."""
    schema, dot, name = table.rpartition(".")
    quote = name[0] if name[:1] in ('"', "`") else ""
    plain = name.strip(quote) if quote else name
    return f"{schema}{dot}{quote}{plain[: _NAME_LENGTH - len(mark) - 1]}_{mark}{quote}"


def swap_statements(table: str, staged: str, columns: Sequence[str]) -> list[str]:
    """What makes the staged rows the table's, to be run as one transaction.

    The table keeps its grants, indexes and views: its rows are replaced, not the table.
    """
    named = ", ".join(columns)
    return [f"DELETE FROM {table}", f"INSERT INTO {table} ({named}) SELECT {named} FROM {staged}"]


def run_in_one_transaction(spark: SparkSession, connection: Mapping[str, str], statements: Sequence[str]) -> None:
    """Run statements on one connection of the driver: all of them take effect, or none."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in connection.items():
        if name not in ("url", "driver"):
            settings.setProperty(name, value)
    if "driver" in connection:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(connection["driver"])
    opened = jvm.java.sql.DriverManager.getConnection(connection["url"], settings)
    try:
        opened.setAutoCommit(False)
        statement = opened.createStatement()
        for sql in statements:
            statement.execute(sql)
        opened.commit()
    except Exception:
        opened.rollback()
        raise
    finally:
        opened.close()


def write_table(
    df: DataFrame,
    table: str,
    connection: Mapping[str, str],
    connections: int = 8,
    batch_rows: int = 10_000,
    attempts: int = 3,
    execute: Callable[[Sequence[str]], None] | None = None,
) -> None:
    """Replace the rows of a table by ``df``, which readers see at once and as a whole.

    Executors write to a staging table over several connections. Each task commits once, but one whose
    executor is lost after the commit runs again and repeats its rows; so the staged rows are counted,
    and staged anew when the count is off. Only a complete stage replaces the rows of the table, in one
    transaction; when no attempt is complete the table stays as it was. The stage is dropped in any case.
    Pass a stored table: it is read for the count and for each attempt.

    ``execute`` runs statements as one transaction; by default on a connection of the driver.
    """
    spark = df.sparkSession
    execute = execute or (lambda statements: run_in_one_transaction(spark, connection, statements))
    staged = staging_name(table, uuid.uuid4().hex[:12])

    def append(rows: DataFrame, target: str, mode: str, **options: object) -> None:
        (
            rows.write.format("jdbc")
            .mode(mode)
            .options(**connection)
            .option("dbtable", target)
            .option("numPartitions", connections)
            .option("batchsize", batch_rows)
            .options(**options)
            .save()
        )

    # The first run of all creates the table, without rows; later ones leave it as it is.
    append(df.limit(0), table, "append")
    expected, found = df.count(), -1
    try:
        for _ in range(attempts):
            append(df, staged, "overwrite", truncate=True)
            found = read_query(spark, f"SELECT COUNT(*) AS written FROM {staged}", connection).first()[0]
            if found == expected:
                execute(swap_statements(table, staged, [_quoted(c) for c in df.columns]))
                return
    finally:
        execute([f"DROP TABLE IF EXISTS {staged}"])
    raise RuntimeError(f"{table}: {found} rows staged, {expected} expected; the table is as it was")


def _quoted(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'
