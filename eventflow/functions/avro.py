"""What the Avro support on the classpath can do, and record files as events."""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.fingerprint import schema_hash
from eventflow.schema import header_map

HASH_HEADER = "avro.schema.hash"
LITERAL_HEADER = "avro.schema.literal"
URL_HEADER = "avro.schema.url"

#: Record of an event in Avro files: neither headers nor body is null.
EVENT_RECORD = json.dumps({
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "headers", "type": {"type": "map", "values": "string"}},
        {"name": "body", "type": "bytes"},
    ],
})

#: Data source names to try: the packaged one, then the bundled file format class.
FORMAT_NAMES = ("avro", "org.apache.spark.sql.avro.AvroFileFormat")


def avro_format(spark: SparkSession) -> str | None:
    """Name to give ``format()`` for Avro files, or None when they are unsupported."""
    empty = spark.createDataFrame([], T.StructType([T.StructField("x", T.IntegerType())]))
    for name in FORMAT_NAMES:
        try:
            # Resolving the source fails early when it is absent; no file is touched.
            spark.read.format(name).schema(empty.schema).load([])
            return name
        except PySparkException as error:
            if "path" in str(error).lower() and "data source" not in str(error).lower():
                return name
    return None


def avro_codec(spark: SparkSession) -> bool:
    """Whether ``to_avro`` / ``from_avro`` work (they need the Avro package)."""
    from pyspark.sql.avro.functions import to_avro

    try:
        spark.range(0).select(to_avro(F.struct("id"))).schema
        return True
    except PySparkException:
        return False


def event_file_format(spark: SparkSession) -> str:
    name = avro_format(spark)
    if name is None:
        raise RuntimeError("Avro files are not supported by this session; ask for another format")
    return name


def read_avro_records(
    spark: SparkSession, path: str, schema: str, *, schema_type: str = "HASH", codec: str = "avro"
) -> DataFrame:
    """Records of Avro files as events: the record is the body, its schema a header.

    ``schema_type`` HASH puts the 64-bit fingerprint, LITERAL the schema text. The Avro
    codec needs the Avro package; ``codec='json'`` writes bodies as JSON instead.
    """
    name = avro_format(spark)
    if name is None:
        raise RuntimeError("Avro files are not supported by this session")
    rows = spark.read.format(name).option("avroSchema", schema).load(path)
    record = F.struct(*rows.columns)
    if codec == "avro":
        if not avro_codec(spark):
            raise RuntimeError("Avro bodies need the Avro package on the classpath")
        from pyspark.sql.avro.functions import to_avro

        body = to_avro(record, schema)
    else:
        body = F.to_json(record).cast("binary")
    if schema_type.upper() == "HASH":
        headers = header_map({HASH_HEADER: F.lit(schema_hash(schema))})
    else:
        literal = json.dumps(json.loads(schema), separators=(",", ":"))
        headers = header_map({LITERAL_HEADER: F.lit(literal)})
    return rows.select(headers.alias("headers"), body.alias("body"))
