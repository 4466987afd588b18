"""Small helpers shared by the operators: scratch tables, text columns, hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.text import released

from sitegrid.operators.spatial import cell_field, may_have
from sitegrid.session import shared_dir, written

__all__ = ["fold", "gathered", "may_be_in", "prepare", "read", "shared_dir", "unused", "without", "written"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string")) % n


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, for a helper column beside its own."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches: a Python worker holds a batch of texts and blocks of it."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")


def gathered(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a table of bounded size as arrays on the driver, packed by tasks.

    Whole numbers arrive as 64-bit integers, others as doubles; rows come in no order."""
    whole = {c: t in ("tinyint", "smallint", "int", "bigint", "boolean") for c, t in df.dtypes}
    schema = pa.schema([(c, pa.binary()) for c in df.columns])
    kinds = {c: np.int64 if whole[c] else np.float64 for c in df.columns}

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(c).to_numpy(zero_copy_only=False).astype(kinds[c]).tobytes()], pa.binary()) for c in kinds], schema=schema)

    rows = df.mapInArrow(released(run), from_arrow_schema(schema)).collect()
    return {c: np.concatenate([np.zeros(0, kinds[c]), *(np.frombuffer(r[c], kinds[c]) for r in rows)]) for c in kinds}


def may_be_in(keys: DataFrame, key: str) -> Column:
    """A filter that holds for all rows whose key (an SQL expression over columns) is in `keys`, and for few others.

    A bit field of fixed size stands for the keys. Where they are few, a join or a sort
    then moves few rows; where they are many, the filter lets all rows pass."""
    return may_have(cell_field(keys.selectExpr(f"xxhash64({key}) AS cell")), f"xxhash64({key})")


def without(docs: DataFrame, ids: DataFrame, on: str = "doc_id") -> DataFrame:
    """Rows of docs whose `on` is not in ids; rows without a value stay. Rows that cannot be in ids are not shuffled."""
    maybe = may_be_in(ids, on)
    rest = docs.where(maybe).join(ids.select(on), on, "left_anti").select(*docs.columns)
    return docs.where(~maybe).unionByName(rest)
