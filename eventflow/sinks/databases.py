"""Database output: plain appends by Spark, keyed writes per partition.

Statements that Spark's JDBC writer cannot express (update, upsert, templates) run
from the tasks through a driver-supplied connection factory (any DB-API module).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.operators.merge import fold_updates, insert_rows

PARAMETER = re.compile(r"\$\{(?P<part>[^\s:}]+):(?P<type>[^\s}]+)\}")  # fixed: ${name:type}
BATCH = 100

# SQL type names in templates.
SQL_TYPES = {
    "VARCHAR": "string",
    "CHAR": "string",
    "CLOB": "string",
    "INTEGER": "int",
    "INT": "int",
    "BIGINT": "bigint",
    "SMALLINT": "smallint",
    "TINYINT": "tinyint",
    "FLOAT": "double",
    "DOUBLE": "double",
    "REAL": "float",
    "DECIMAL": "decimal(38,10)",
    "NUMERIC": "decimal(38,10)",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "BLOB": "binary",
    "VARBINARY": "binary",
    "LONGVARCHAR": "string",
    "NVARCHAR": "string",
    "NCHAR": "string",
    "LONGNVARCHAR": "string",
    "NCLOB": "string",
    "BIT": "boolean",
    "BINARY": "binary",
    "LONGVARBINARY": "binary",
    "TIME": "string",
}


def jdbc_insert(
    df: DataFrame, url: str, table: str, target_schema: T.StructType,
    properties: dict[str, str] | None = None, batch_size: int = BATCH,
) -> None:
    """Append mapped fields; columns no field maps to take their default."""
    rows = insert_rows(df, target_schema)
    rows.write.jdbc(
        url, table, mode="append", properties={**(properties or {}), "batchsize": str(batch_size)}
    )


@dataclass(frozen=True)
class Template:
    """A statement with ``${field:type}`` parameters."""

    sql: str
    parameters: tuple[tuple[str, str], ...]

    @classmethod
    def parse(cls, text: str, placeholder: str = "?") -> "Template":
        found = tuple((m["part"], m["type"].upper()) for m in PARAMETER.finditer(text))
        unknown = sorted({kind for _, kind in found} - set(SQL_TYPES))
        if unknown:
            raise ValueError(f"unknown SQL types: {', '.join(unknown)}")
        return cls(PARAMETER.sub(placeholder, text), found)

    def bindings(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """One typed column per parameter (``p0``, ``p1``, …); unknown fields are null."""
        by_name = {c.lower(): c for c in df.columns}
        columns = []
        for i, (part, kind) in enumerate(self.parameters):
            source = by_name.get(part.lower())
            value = F.lit(None) if source is None else F.col(source)
            columns.append(value.cast(SQL_TYPES[kind]).alias(f"p{i}"))
        return df.select(*keep, *columns)


def run_batches(
    df: DataFrame,
    connect: Callable[[], object],
    statement: str | list[tuple[str, list[int]]],
    batch_size: int = BATCH,
) -> None:
    """Execute prepared statements per row, in batches, one connection and commit per task.

    A single statement takes all columns; of several each names the places of its own.
    """
    steps = [(statement, None)] if isinstance(statement, str) else statement

    def execute(cursor, pending: list[tuple]) -> None:
        for sql, places in steps:
            rows = pending if places is None else [tuple(r[i] for i in places) for r in pending]
            cursor.executemany(sql, rows)

    def send(rows) -> None:
        connection = None
        try:
            pending = []
            for row in rows:
                if connection is None:
                    connection = connect()
                    cursor = connection.cursor()
                pending.append(tuple(row))
                if len(pending) >= batch_size:
                    execute(cursor, pending)
                    pending = []
            if pending:
                execute(cursor, pending)
            if connection is not None:
                connection.commit()
        finally:
            if connection is not None:
                connection.close()

    df.foreachPartition(send)


def jdbc_template(
    df: DataFrame, sql: str, connect: Callable[[], object], placeholder: str = "?",
    batch_size: int = BATCH,
) -> None:
    """Run a template once per row."""
    template = Template.parse(sql, placeholder)
    run_batches(template.bindings(df), connect, template.sql, batch_size)


def jdbc_generated(
    df: DataFrame,
    generate: Callable[[DataFrame], tuple[str, DataFrame]],
    connect: Callable[[], object],
    batch_size: int = BATCH,
) -> None:
    """Run the statement that ``generate`` makes for the events, once per row it returns."""
    statement, rows = generate(df)
    run_batches(rows, connect, statement, batch_size)


def upsert_statement(table: str, columns: list[str], keys: list[str], placeholder: str = "?") -> str:
    """Insert, or update the non-null fields of the existing row."""
    values = ", ".join(placeholder for _ in columns)
    fields = [c for c in columns if c not in keys]
    sets = ", ".join(f"{c} = COALESCE(excluded.{c}, {table}.{c})" for c in fields)
    action = f"DO UPDATE SET {sets}" if sets else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({values}) "
        f"ON CONFLICT ({', '.join(keys)}) {action}"
    )


def _folded(df: DataFrame, columns: list[str], keys: list[str], order: list[str]) -> DataFrame:
    """One row per key with the mapped columns, those of the order among them."""
    by_name = {c.lower(): c for c in df.columns}
    mapped = [F.col(by_name[c.lower()]).alias(c) for c in columns if c.lower() in by_name]
    steps = [F.col(c).alias(f"_order{i}") for i, c in enumerate(order)]
    names = [f"_order{i}" for i in range(len(order))]
    return fold_updates(df.select(*mapped, *steps), keys, names).drop(*names)


def jdbc_upsert(
    df: DataFrame, table: str, columns: list[str], keys: list[str], order: list[str],
    connect: Callable[[], object], placeholder: str = "?", batch_size: int = BATCH,
) -> None:
    """Upsert events. Updates of a key are folded first, so each key is written by one
    task, once; repeating the write changes nothing."""
    folded = _folded(df, columns, keys, order)
    cols = [c for c in columns if c in folded.columns]
    statement = upsert_statement(table, cols, keys, placeholder)
    run_batches(folded.select(*cols), connect, statement, batch_size)


def jdbc_update_or_insert(
    df: DataFrame, table: str, columns: list[str], key: str, order: list[str],
    connect: Callable[[], object], where: list[str] = (), placeholder: str = "?",
    batch_size: int = BATCH,
) -> None:
    """Update the row with the same key, or insert it.

    A null field leaves the stored value; a ``where`` field is compared, not set.
    """
    folded = _folded(df, columns, [key], order)
    cols = [c for c in columns if c in folded.columns]
    fields = [c for c in cols if c != key and c not in where]
    sets = ", ".join(f"{c} = COALESCE({placeholder}, {c})" for c in fields)
    tests = [f"{key} = {placeholder}"] + [
        f"({placeholder} IS NULL OR {w} = {placeholder})" for w in where
    ]
    insert = (
        f"INSERT INTO {table} ({', '.join(cols)}) SELECT {', '.join(placeholder for _ in cols)} "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} WHERE {key} = {placeholder})"
    )
    steps = [(insert, [*cols, key])]
    if fields:
        update = f"UPDATE {table} SET {sets} WHERE {' AND '.join(tests)}"
        steps.insert(0, (update, [*fields, key, *[w for w in where for _ in (0, 1)]]))
    # Both statements of a task's keys share one connection and one commit.
    places = {c: i for i, c in enumerate(cols)}
    run_batches(
        folded.select(*cols), connect, [(sql, [places[c] for c in used]) for sql, used in steps],
        batch_size,
    )
