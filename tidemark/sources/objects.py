"""JSON objects that stand one behind the other in a text, or in lists."""

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decoded(text: str) -> list:
    """All objects of a text; what follows a broken one is left out."""
    reader, out, at = json.JSONDecoder(), [], 0
    while at < len(text):
        if text[at].isspace() or text[at] == ",":
            at += 1
            continue
        try:
            value, at = reader.raw_decode(text, at)
        except ValueError:
            break
        out += [x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict)]
    return out


def objects(rows: DataFrame, key: str, body: str, fields: str) -> DataFrame:
    """(key, fields) of every object in a text column; fields as a DDL string."""

    def run(batches):
        for batch in batches:
            found = [(k, json.dumps(o)) for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for o in decoded(text or "")]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], batch.schema.field(0).type), pa.array([o for _, o in found], pa.string())], [key, "object"])

    kind = rows.schema[key].dataType.simpleString()
    each = rows.select(key, F.col(body).alias("body")).mapInArrow(run, f"{key} {kind}, object string")
    return each.select(key, F.from_json("object", f"struct<{', '.join(': '.join(f.split()) for f in fields.split(','))}>").alias("o")).select(key, "o.*")
