"""Arrays packed into rows: a task sends one row per bucket instead of one per entry."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text that a bucket holds on the average, at most. A task has one bucket in memory at a time.
BUCKET_BYTES = 64_000_000

KINDS = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}


def free_name(columns: list[str], name: str) -> str:
    """`name`, with underscores until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def buckets_for(docs: DataFrame, text: str, most: int = BUCKET_BYTES) -> int:
    """So many buckets that none holds over `most` bytes of text on the average, and one for each shuffle partition at least.

    The bytes are summed up by a job of its own that reads the text column.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // most))


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True)


def read_packed(table: pa.Table, name: str, kind, row: int = 1) -> np.ndarray:
    """A packed column as one array; the column `count` has the number of entries of each row, of `row` values each."""
    size = np.dtype(kind).itemsize * row
    parts = zip(table.column("count").to_pylist(), table.column(name).to_pylist(), strict=True)
    return np.frombuffer(b"".join(pa.decompress(data, count * size, "zstd", asbytes=True) for count, data in parts if count), kind)


def table_of(rows: list, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ddl_of(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {KINDS[f.type]}" for f in schema)


def split_rows(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each bucket, in their order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(bucket[rows[0]]), rows


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def home_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket that a document's findings go to."""
    return (scramble(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def home_column(buckets: int):
    """`home_of` as a function of a column. Documents without an id have no findings and may go anywhere."""

    @F.arrow_udf("int")
    def home(ids: pa.Array) -> pa.Array:
        anywhere = np.arange(len(ids))
        known = np.where(np.array(ids.is_null()), anywhere, np.array(ids.fill_null(0), np.int64))
        return pa.array(home_of(known, buckets), pa.int32())

    return home
