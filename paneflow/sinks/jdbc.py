"""Append to a database over JDBC, a micro-batch at a time.

Each Spark task commits on its own, so a write that fails half-way leaves some of its rows.
So the rows go to a staging table of the batch first, in parallel; then one transaction
moves them to the target and enters the batch in a ledger, under its load and id (``sinks.loads``).
A batch that is run again finds itself in the ledger, or starts over with its staging table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schema import DEFAULT_BATCH_ROWS, JDBC_TABLE
from .loads import DEFAULT_LOAD, checked_load

# Fixed value: the most connections opened at a time.
MAX_CONNECTIONS = 50


@dataclass(frozen=True)
class JdbcTarget:
    """A database table and how to reach it; everything is the caller's to give."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    table: str = JDBC_TABLE
    ledger: str | None = None
    rows_per_statement: int = DEFAULT_BATCH_ROWS
    max_connections: int = MAX_CONNECTIONS

    def options(self, table: str | None = None) -> dict[str, str]:
        """Options of Spark's JDBC writer. ``numPartitions`` keeps a large job from
        opening a connection per task."""
        options = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": table or self.table,
            "batchsize": str(self.rows_per_statement),
            "numPartitions": str(self.max_connections),
        }
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return options

    def ledger_table(self) -> str:
        return self.ledger or f"{self.table}_batches"

    def staging_table(self, batch_id: int, load_id: str = DEFAULT_LOAD) -> str:
        load = hashlib.md5(load_id.encode(), usedforsecurity=False).hexdigest()[:12]
        return f"{self.table}_stage_{load}_{int(batch_id)}"


def insert_statement(table: str, columns: Sequence[str]) -> str:
    """The parameterised insert that a batch runs."""
    marks = ", ".join("?" for _ in columns)
    return f"insert into {table}({', '.join(columns)}) values ({marks})"


def ledger_query(target: JdbcTarget, batch_id: int, load_id: str = DEFAULT_LOAD) -> str:
    where = f"load_id = '{checked_load(load_id)}' and batch_id = {int(batch_id)}"
    return f"select count(*) from {target.ledger_table()} where {where}"


def commit_statements(
    target: JdbcTarget, columns: Sequence[str], batch_id: int, load_id: str = DEFAULT_LOAD
) -> list[str]:
    """What one transaction runs to move a staged batch to the target."""
    names, staging = ", ".join(columns), target.staging_table(batch_id, load_id)
    return [
        f"insert into {target.table}({names}) select {names} from {staging}",
        f"insert into {target.ledger_table()}(load_id, batch_id) values ('{checked_load(load_id)}', {int(batch_id)})",
    ]


def jvm_connection(spark: SparkSession, target: JdbcTarget):
    """A connection from the driver's JVM, for the few statements around the writes. The JVM is at
    hand in a classic session only, not through Spark Connect; give ``connect`` there."""
    jvm = spark._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = loader.loadClass(target.driver).getDeclaredConstructor(None).newInstance(None)
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if getattr(target, name) is not None:
            properties.setProperty(name, getattr(target, name))
    connection = driver.connect(target.url, properties)
    if connection is None:
        raise ConnectionError(f"{target.driver} does not take the URL {target.url}")
    return connection


def write_rows(rows: DataFrame, target: JdbcTarget, table: str | None = None, mode: str = "append") -> None:
    """Plain parallel write: at least once."""
    rows.write.format("jdbc").options(**target.options(table)).mode(mode).save()


def append_batch(
    rows: DataFrame,
    batch_id: int,
    target: JdbcTarget,
    load_id: str = DEFAULT_LOAD,
    *,
    connect: Callable[[SparkSession, JdbcTarget], object] = jvm_connection,
    write: Callable[..., None] = write_rows,
) -> bool:
    """Write a batch once. True if it was written, False if the ledger had it already.

    The target and its ledger (``load_id VARCHAR(64), batch_id BIGINT``, both the primary key) must
    exist; a failure to connect is raised. A staging table that an earlier try left is dropped.
    """
    spark = rows.sparkSession
    staging = target.staging_table(batch_id, load_id)
    connection = connect(spark, target)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        found = statement.executeQuery(ledger_query(target, batch_id, load_id))
        found.next()
        done = found.getInt(1) > 0
        connection.commit()
        if not done:
            write(rows, target, staging, "overwrite")
            try:
                for sql in commit_statements(target, rows.columns, batch_id, load_id):
                    statement.executeUpdate(sql)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        statement.executeUpdate(f"drop table if exists {staging}")
        connection.commit()
        return not done
    finally:
        connection.close()
