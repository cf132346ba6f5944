"""Text columns that hold CSV, JSON, XML or YAML, as typed structs. What cannot be read is null; nothing is inferred."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.runtime import ship

_BAD = "_corrupt_record"


def _whole(parsed: Column, schema: str, text: Column) -> Column:
    """The struct, without the mark of a text that could not be read; null if it has one."""
    names = [f.split(":")[0].split()[0] for f in _fields(schema)]
    return F.when(text.isNotNull() & parsed[_BAD].isNull(), F.struct(*[parsed[n].alias(n) for n in names]))


def _fields(schema: str) -> list[str]:
    """The fields of a DDL schema: parts between commas outside of brackets."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(schema[last:i].strip())
            last = i + 1
    return [*out, schema[last:].strip()]


def csv(text: Column, schema: str, delimiter: str = ",") -> Column:
    """One line of CSV as a struct of the schema (DDL)."""
    return _whole(F.from_csv(text, f"{schema}, {_BAD} string", {"sep": delimiter, "columnNameOfCorruptRecord": _BAD}), schema, text)


def json_object(text: Column, schema: str) -> Column:
    """A JSON object as a struct of the schema."""
    return _whole(F.from_json(text, f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD}), schema, text)


def xml(text: Column, schema: str, attribute_prefix: str = "_") -> Column:
    """An XML element as a struct of the schema; attributes are fields with a prefix."""
    return _whole(F.from_xml(text, f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD, "attributePrefix": attribute_prefix}), schema, text)


def yaml(df: DataFrame, column: str, schema: str, name: str) -> DataFrame:
    """df with a YAML mapping as a struct of the schema. Spark has no reader of YAML: documents become JSON in Arrow batches, if PyYAML is there."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import yaml as reader

        for batch in batches:
            texts = []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                try:
                    found = reader.safe_load(t) if t is not None else None
                    texts.append(json.dumps(found, default=str) if isinstance(found, dict) else None)
                except reader.YAMLError:
                    texts.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], batch.schema.names)

    given = df.withColumn("_yaml", F.col(column))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return given.mapInArrow(run, ddl).withColumn(name, json_object(F.col("_yaml"), schema)).drop("_yaml")
