"""Measurements of whole texts as rows, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.functions import measure

COLUMNS = "a long, b long, value_text string, kind string, comparator string, value double, unit string, dimension string, base double"


def measurements(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a, b, value_text, kind, comparator, value, unit, dimension, base): one row a measurement; a null or empty text has none.

    `value` is the first number and `unit` the first unit of the span; `dimension` is null where the span has none, "mixed" where it has several.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in measure.find(t):
                    unit = next((u for _, u in f.values if u), None)
                    dims = {d for _, u in f.values if (d := measure.dimension(u))}
                    rows.append((k, f.a, f.b, t[f.a : f.b], f.kind, f.comparator, f.values[0][0], unit, dims.pop() if len(dims) == 1 else "mixed" if dims else None, measure.base(f.values[0][0], unit)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 10
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[key, "a", "b", "value_text", "kind", "comparator", "value", "unit", "dimension", "base"])

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, {COLUMNS}")
