"""Running totals over rows in order, in whole or by groups, without a task that sees all rows.

Rows are sorted into ranges; each range sums its own rows, and takes over what the ranges
before it have come to. A group that goes over many ranges is no exception.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gleanery.llm.common import written

PART, NTH = "__part", "nth"


def _within(values: np.ndarray, fresh: np.ndarray, carry: int, xor: bool) -> np.ndarray:
    """Inclusive totals that begin anew at `fresh` places; rows before the first of them go on from carry."""
    at = np.maximum.accumulate(np.where(fresh, np.arange(len(values)), -1))
    op, inverse = (np.bitwise_xor, np.bitwise_xor) if xor else (np.add, np.subtract)
    total = op.accumulate(values)
    before = np.concatenate([[0], total])[np.maximum(at, 0)]
    return np.where(at < 0, op(total, carry), inverse(total, before))


def _summed(group: Sequence[str], sums: Sequence[str], xors: Sequence[str], schema: pa.Schema):
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carry = TaskContext.get().partitionId(), None, dict.fromkeys((NTH, *sums, *xors), 0)
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(b.schema.get_field_index(g)).to_numpy(zero_copy_only=False) for g in group]
            fresh = np.zeros(b.num_rows, bool)
            for k in keys:
                fresh[1:] |= k[1:] != k[:-1]
            if last is not None:
                fresh[0] = any(k[0] != v for k, v in zip(keys, last))
            made = {PART: np.full(b.num_rows, part, np.int32)}
            for name in carry:
                values = np.ones(b.num_rows, np.int64) if name == NTH else b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
                made[name] = _within(values, fresh, carry[name], name in xors)
            carry = {name: made[name][-1] for name in carry}
            last = [k[-1] for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else b.column(b.schema.get_field_index(f.name)) for f in schema], schema=schema)

    return totals


def running(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], keep: Sequence[str], sums: Sequence[str] = (), xors: Sequence[str] = (), name: str = "running") -> DataFrame:
    """group, keep, nth (1-based place in the group by `order`), and `sums` and `xors` (longs, never null)
    as inclusive running totals within the group; without group columns, over all rows.

    Group columns are longs without nulls. Rows that tie in `order` keep any order among
    themselves, settled once. The result is written, so all that reads it sees the same. To the driver comes a
    row for each range, whatever the rows.
    """
    columns = [*group, *keep, *sums, *xors]
    keys = [*group, *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*columns)
    shape = dealt.select(F.lit(0).alias(PART), F.lit(0).cast("long").alias(NTH), *columns).schema
    own = written(dealt.mapInArrow(_summed(group, sums, xors, to_arrow_schema(shape)), shape), name)
    totals = [NTH, *sums, *xors]
    place = F.struct(*group, NTH)  # within a range, rows ascend by group and place
    ranges = own.groupBy(PART).agg(F.min(place).alias("lo"), F.max_by(F.struct(*group, *totals), place).alias("hi")).orderBy(PART).collect()
    carries, so_far, of = [], dict.fromkeys(totals, 0), None
    for part, lo, hi in ranges:
        first, final = tuple(lo[g] for g in group), tuple(hi[g] for g in group)
        if of is not None and first == of:
            carries.append((part, *first, *(so_far[t] for t in totals)))
        before = so_far if of is not None and final == of else dict.fromkeys(totals, 0)
        so_far = {t: before[t] ^ hi[t] if t in xors else before[t] + hi[t] for t in totals}
        of = final
    if not carries:
        return own.drop(PART)
    kinds = ", ".join([f"{PART} int", *(f"`{g}` long" for g in group), *(f"`{t}` long" for t in totals)])
    more = rows.sparkSession.createDataFrame(carries, kinds).withColumnsRenamed({t: f"__{t}" for t in totals})
    met = own.join(F.broadcast(more), [PART, *group], "left")
    value = lambda t: F.coalesce(F.col(f"__{t}"), F.lit(0))
    total = lambda t: F.col(t).bitwiseXOR(value(t)) if t in xors else F.col(t) + value(t)
    return met.select(*group, *keep, *(total(t).alias(t) for t in totals))
