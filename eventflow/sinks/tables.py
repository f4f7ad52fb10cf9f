"""Partitioned tables and schema-checked datasets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions import records as R
from eventflow.functions.avro import LITERAL_HEADER, URL_HEADER, avro_codec, event_file_format
from eventflow.functions.bucketing import bucket_path
from eventflow.functions.text import split_delimited


def delimited_rows(
    df: DataFrame, names: list[str], schema: T.StructType, delimiter: str = ",",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Delimited bodies to the table's columns; columns without a field are null."""
    fields = split_delimited(F.col("body").cast("string"), names, delimiter)
    parts = df.select(*keep, *fields)
    present = {c.lower(): c for c in parts.columns}
    return parts.select(
        *keep,
        *[
            F.col(present[f.name.lower()]).try_cast(f.dataType).alias(f.name)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
    )


def json_rows(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON object bodies to the table's columns; a body that is no object raises."""
    row = F.from_json(F.col("body").cast("string"), schema, {"mode": "FAILFAST"})
    return df.select(*keep, row.alias("_r")).select(*keep, "_r.*")


def partition_values(patterns: dict[str, str], **options) -> dict[str, Column]:
    """Partition columns, each expanded from its pattern per event."""
    return {name: bucket_path(p, F.col("headers"), **options) for name, p in patterns.items()}


def write_partitioned_table(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    *,
    partitions: dict[str, str] | None = None,
    serializer: str = "DELIMITED",
    names: list[str] | None = None,
    delimiter: str = ",",
    path: str | None = None,
    fmt: str = "parquet",
    **options,
) -> None:
    """Append events to a table; new partitions are created as they appear."""
    values = partition_values(partitions or {}, **options)
    staged = df.select(*[v.alias(n) for n, v in values.items()], "headers", "body")
    keep = tuple(values)
    if serializer == "DELIMITED":
        rows = delimited_rows(staged, names or schema.fieldNames(), schema, delimiter, keep)
    elif serializer == "JSON":
        rows = json_rows(staged, schema, keep)
    else:
        raise ValueError("serializer must be DELIMITED or JSON")
    out = rows.write.format(fmt).mode("append")
    if values:
        out = out.partitionBy(*values)
    if path:
        out.save(path)
    else:
        out.saveAsTable(table)


@dataclass(frozen=True)
class RecordSchema:
    """The record type of a dataset or of what was written to it."""

    kind: R.Kind
    text: str

    @classmethod
    def parse(cls, text: str) -> "RecordSchema":
        kind = R.parse_schema(text)
        if kind.name != "record":
            raise ValueError("a dataset holds records")
        return cls(kind, text)

    @property
    def name(self) -> str:
        return self.kind.label

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {R.spark_type(f.kind)}" for f in self.kind.fields)

    def reads(self, writer: "RecordSchema") -> bool:
        """Whether some of what ``writer`` writes can be read."""
        try:
            R.resolve(writer.kind, self.kind)
        except R.Incompatible:
            return False
        return True


def decode_dataset(
    df: DataFrame,
    table: RecordSchema,
    writers: dict[str, str],
    *,
    codec: str = "json",
    literal_header: str = LITERAL_HEADER,
    url_header: str = URL_HEADER,
    parser: Callable[[Column, str], Column] | None = None,
) -> DataFrame:
    """Bodies decoded by the schema their header names, resolved to the table schema.

    ``writers`` maps a header value (URL or literal) to schema text; the URL header wins.
    Schemas may nest records, arrays, maps, unions, enums, fixed and logical types, and
    are resolved as records are read: see ``records.resolve``. Adds ``row``, null when the
    event cannot be decoded: an unknown or unreadable schema, a body that is not what its
    schema writes, or a value (of an enum or union) that the table has no place for.

    JSON bodies hold each value plainly: a union's value without its type (the first choice
    that it fits counts), bytes as base64, decimals as numbers, dates and timestamps as the
    numbers their schema says; fields that the schema lacks are ignored, a missing one is
    null. One pass, each body is parsed once, no grouping. ``parser`` (body, schema text)
    -> struct of the writer's types replaces the codec; null is an event it cannot read.
    """
    h = F.col("headers")
    which = F.coalesce(h[url_header], h[literal_header])
    if codec == "avro":
        if not avro_codec(df.sparkSession):
            raise RuntimeError("Avro bodies need the Avro package on the classpath")
        from pyspark.sql.avro.functions import from_avro
    # First decode (each body by one schema only), then resolve: a decoded value is used
    # once per field and must not be parsed again for each.
    values, rows = [], []
    for key, text in writers.items():
        writer = R.parse_schema(text)
        mode = R.TYPED if codec == "json" and parser is None else R.NATIVE
        try:
            found = R.resolve(writer, table.kind, mode)
        except R.Incompatible:
            continue
        name = f"_v{len(values)}"
        held = F.col(name)
        if parser is not None:
            value = parser(F.col("body"), text)
        elif codec == "avro":  # the codec resolves both schemas itself
            value = from_avro(F.col("body"), text, {"mode": "PERMISSIVE", "avroSchema": table.text})
        else:
            fields = ", ".join(f"`{f.name}` {R.json_type(f.kind)}" for f in writer.fields)
            options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
            value = F.from_json(F.col("body").cast("string"), f"{fields}, _corrupt string", options)
        values.append(F.when(which == key, value).alias(name))
        decoded = held.isNotNull()
        if mode == R.TYPED:
            decoded = decoded & held["_corrupt"].isNull() & R.written(writer, mode, held)
        if codec == "avro" and parser is None:
            rows.append(F.when(decoded, held))
        else:
            rows.append(F.when(decoded & found.sure(held), found.value(held)))
    target = R.spark_type(table.kind)
    row = F.coalesce(*[r.cast(target) for r in rows], F.lit(None).cast(target))
    staged = df.select("*", *values)
    return staged.withColumn("row", row).drop(*[f"_v{i}" for i in range(len(values))])


def write_dataset(
    df: DataFrame,
    path: str,
    table: RecordSchema,
    writers: dict[str, str],
    *,
    fmt: str = "parquet",
    failure_policy: str | Callable[[DataFrame], None] = "retry",
    error_path: str | None = None,
    mode: str = "append",
    **options,
) -> None:
    """Write decodable events as typed rows; treat the rest by policy.

    ``retry`` raises before anything is written, ``save`` writes the original events to the
    error dataset (in the same ``mode``), a callable receives them.
    """
    decoded = decode_dataset(df, table, writers, **options).persist()
    try:
        _write_decoded(decoded, path, fmt, failure_policy, error_path, mode)
    finally:
        decoded.unpersist()


def _write_decoded(decoded, path, fmt, failure_policy, error_path, mode) -> None:
    bad = decoded.filter(F.col("row").isNull()).select("headers", "body")
    if failure_policy == "retry":
        if not bad.isEmpty():
            raise RuntimeError("events that do not fit the dataset schema; batch rolled back")
    elif failure_policy == "save":
        if not error_path:
            raise ValueError("failure policy 'save' needs error_path")
        bad.write.mode(mode).parquet(error_path)
    else:
        failure_policy(bad)
    rows = decoded.filter(F.col("row").isNotNull()).select("row.*")
    if fmt == "avro":
        fmt = event_file_format(decoded.sparkSession)
    rows.write.mode(mode).format(fmt).save(path)


def dataset_writer(
    path: str, table_schema: Callable[[], str], writers: dict[str, str], **options
) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer that reads the table schema anew for every batch, so a changed
    schema applies from the next batch on. Rows and dead letters of a batch have a folder of
    their own, so a repeated batch replaces both."""

    def write(df: DataFrame, batch_id: int) -> None:
        own = dict(options)
        if own.get("error_path"):
            own["error_path"] = f"{own['error_path'].rstrip('/')}/batch_id={batch_id}"
        target = f"{path.rstrip('/')}/batch_id={batch_id}"
        write_dataset(
            df, target, RecordSchema.parse(table_schema()), writers, mode="overwrite", **own
        )

    return write
