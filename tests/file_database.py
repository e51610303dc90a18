"""A database's part in the JDBC sink, in files, where no database is at hand.

It takes the statements that ``sinks.jdbc`` runs and no others. Tables are folders of Parquet files;
what a transaction inserts shows when it commits.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from paneflow.sinks.jdbc import JdbcTarget


class FileDatabase:
    """Connection, statement and result in one; ``connect`` and ``write`` are what the sink asks for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.schemas = {}
        self.ledger: set[tuple[str, str]] = set()
        self.pending: list[str] = []

    def connect(self, spark: SparkSession, target: JdbcTarget) -> FileDatabase:
        return self

    def write(self, rows: DataFrame, target: JdbcTarget, table: str, mode: str) -> None:
        self.schemas[table] = rows.schema
        rows.write.mode(mode).parquet(f"{self.folder}/{table}")

    def rows(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[table]).parquet(f"{self.folder}/{table}")

    def setAutoCommit(self, on: bool) -> None:
        assert not on

    def createStatement(self) -> FileDatabase:
        return self

    def executeQuery(self, sql: str) -> FileDatabase:
        self.asked = re.search(r"load_id = '(.+)' and batch_id = (\d+)", sql).groups()
        return self

    def next(self) -> bool:
        return True

    def getInt(self, column: int) -> int:
        return int(self.asked in self.ledger)

    def executeUpdate(self, sql: str) -> None:
        self.pending.append(sql)

    def commit(self) -> None:
        for sql in self.pending:
            if moved := re.fullmatch(r"insert into (\w+)\(.+\) select .+ from (\w+)", sql):
                table, staged = moved.groups()
                self.schemas[table] = self.schemas[staged]
                self.rows(staged).write.mode("append").parquet(f"{self.folder}/{table}")
            elif entered := re.search(r"values \('(.+)', (\d+)\)", sql):
                self.ledger.add(entered.groups())
        self.pending = []

    def rollback(self) -> None:
        self.pending = []

    def close(self) -> None:
        self.pending = []
