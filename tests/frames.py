"""Small frames that need no Python worker to be read."""

import pyarrow as pa

TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "long": pa.int64(),
    "timestamp": pa.timestamp("us", "UTC"),
}


def local_frame(spark, rows, ddl):
    """Rows as a local relation; `ddl` as `name type, ...` with the types above."""
    fields = [field.split() for field in ddl.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return spark.createDataFrame(
        pa.table(
            {
                name: pa.array(list(values), TYPES[kind])
                for (name, kind), values in zip(fields, columns, strict=True)
            }
        )
    )
