"""Small helpers shared by the corpus operators.

Columns: every operator selects the columns it needs first, so extra columns of the input, whatever their
names, never reach it. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from echowire.session import small_batches

#: Rows that a task hands to a row function at once, so that a batch of long texts stays small in memory.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text, null as empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def map_rows(df: DataFrame, schema: StructType | str, make: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """Arrow batches through a function that returns one list of values per output column.

    `make` is called once in each task and returns the function; batches reach it in slices of SLICE_ROWS.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                columns = function(batch.slice(at, SLICE_ROWS))
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    return batch.column(name).to_pylist()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()
