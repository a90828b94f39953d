"""Spans found in texts: their Arrow form and the columns derived from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import fresh, quoted, text_of

Span = tuple[str, int, int]
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPARK = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def add_spans(df: DataFrame, text: str, out: str, find: Callable[[pa.Array], list[list[Span]]]) -> DataFrame:
    """Add an array of spans to every row; ``find`` takes a text column without nulls, in slices of at most 512 rows."""
    df = df.drop(out)
    (body,) = fresh(df, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 512):
                batch = whole.slice(i, 512)
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in find(batch.column(body))]
                rest = [n for n in batch.schema.names if n != body]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], pa.array(spans, ARROW)], [*rest, out])

    schema = T.StructType([*df.schema.fields, T.StructField(out, SPARK)])
    return df.withColumn(body, text_of(quoted(text))).mapInArrow(run, schema)


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: str, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of the spans in their order, joined by commas; only of ``kinds`` if given."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(kinds)) if kinds else F.col(spans)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
