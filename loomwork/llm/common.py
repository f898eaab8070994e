"""Small helpers shared by the corpus operators.

Conventions of all of them: a null text counts as an empty one, a null ``doc_id`` is a document of its own row, repeated
rows give repeated results, an empty table gives an empty result, and extra input columns are left alone. Where an operator
adds a column whose name the input already has, the operator's column replaces it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo five, is zero."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def add_columns(docs: DataFrame, schema: str, fn: Callable[[list[str]], list[list]], text: str = "text") -> DataFrame:
    """Add the columns of ``schema``, computed by ``fn`` from the list of texts of an Arrow batch (null becomes empty).

    Rows stay in their partitions and keep all their columns, so nothing is shuffled or joined.
    """
    added = T._parse_datatype_string(schema)
    names = set(added.names)
    kept = [f for f in docs.schema.fields if f.name not in names]
    out = T.StructType(kept + added.fields)
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = fn([t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()])
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns += [pa.array(v, type=f.type) for v, f in zip(values, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + arrow.names)

    return docs.mapInArrow(run, out)
