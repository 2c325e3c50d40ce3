"""What the operators share: Arrow batches in slices, bounded samples, skew-proof joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from blockspark.session import ship

#: Rows that are turned into Python objects at a time, and characters after which a slice ends.
SLICE_ROWS, SLICE_CHARS = 1024, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: int = -1) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, small enough to hold as Python objects.

    text: index of the column whose length counts. A single row is never cut.
    """
    n, start = batch.num_rows, 0
    if text < 0:
        for start in range(0, n, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    held = 0
    for i in range(n):
        held += int(sizes[i])
        if held >= SLICE_CHARS or i - start + 1 >= SLICE_ROWS:
            yield batch.slice(start, i - start + 1)
            start, held = i + 1, 0
    if start < n:
        yield batch.slice(start, n - start)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], list | dict], schema: str, text: int = -1, setup: Callable[[], object] | None = None) -> DataFrame:
    """``fn`` over slices of Arrow batches; it returns columns in the schema's order.

    setup: called once per task; its value is passed to ``fn`` as a second argument.
    """
    ship(df.sparkSession)
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = (setup(),) if setup else ()
        for batch in batches:
            for part in slices(batch, text):
                columns = fn(part, *extra)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, struct)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the rows that no model may learn from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def salted(df: DataFrame, unique: DataFrame, keys: list[str], salts: int = 16, how: str = "left") -> DataFrame:
    """Join ``df`` with a table that has each key once, a hot key being spread.

    A row of ``df`` picks one of ``salts`` parts by its other columns; the unique
    side is repeated for each part, so its size grows by that fixed factor only.
    """
    salt = "__salt"
    left = df.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in keys] or [F.lit(0)]), F.lit(salts)).cast("int"))
    right = unique.withColumn(salt, F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.join(right, [*keys, salt], how).drop(salt)
