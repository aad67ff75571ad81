"""Converters for formats that SQL cannot read (§2.11): whole Arrow batches of record values
become JSON text, in Python workers that see the records of their own routes only.

A batch converter maps an array of binary values to (texts, errors): JSON text of each value, or
the reason why it cannot be read.  If it raises, the batch is tried value by value, and only the
values that raise are in error.  NULL values stay NULL.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BatchConverter = Callable[[pa.Array], tuple[pa.Array, pa.Array]]

#: Batch converters by route name.
BATCH_CONVERTERS: dict[str, BatchConverter] = {}


def register_batch_converter(name: str, convert: BatchConverter) -> None:
    """Make a batch converter available to routes; a later one of the same name replaces it.
    It is sent to the workers, so it must be a picklable function."""
    BATCH_CONVERTERS[name] = convert


def _guarded(convert: BatchConverter, values: pa.Array) -> tuple[pa.Array, pa.Array]:
    try:
        texts, errors = convert(values)
        if len(texts) != len(values) or len(errors) != len(values):
            raise ValueError("a batch converter must give one text and one error for each value")
        return texts.cast(pa.string()), errors.cast(pa.string())
    except Exception as e:
        if len(values) > 1:
            one = [_guarded(convert, values.slice(i, 1)) for i in range(len(values))]
            return pa.concat_arrays([t for t, _ in one]), pa.concat_arrays([x for _, x in one])
        return pa.nulls(1, pa.string()), pa.array([f"{type(e).__name__}: {e}"])


def convert_batches(name: str, values: Column) -> Column:
    """The converter's struct<body, error> of a binary column."""
    convert = BATCH_CONVERTERS[name]

    @F.arrow_udf("struct<body:string,error:string>")
    def run(column: pa.Array) -> pa.Array:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        there = column.filter(column.is_valid())
        place = pc.cumulative_sum(pc.cast(column.is_valid(), pa.int64()))
        place = pc.if_else(column.is_valid(), pc.subtract(place, 1), pa.scalar(None, pa.int64()))
        texts, errors = _guarded(convert, there) if len(there) else (pa.nulls(0, pa.string()), pa.nulls(0, pa.string()))
        return pa.StructArray.from_arrays([texts.take(place), errors.take(place)], ["body", "error"])

    return run(values)


#: The packed event, big-endian, without gaps.
PACKED = np.dtype([("user", ">i8"), ("at", ">i8"), ("cents", ">i8"), ("code", ">u2")])
PACKED_EVENTS = ("view", "click", "purchase")
YEAR_10000 = 253_402_300_800_000  # in epoch milliseconds


def packed_event(values: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Packed events: user number, epoch milliseconds, amount in cents and event code."""
    size = pc.binary_length(values)
    fits = pc.equal(size, PACKED.itemsize)
    rows = np.frombuffer(b"".join(values.filter(fits).to_pylist()), PACKED)
    known, timely = rows["code"] < len(PACKED_EVENTS), (rows["at"] >= 0) & (rows["at"] < YEAR_10000)
    names = np.array([*PACKED_EVENTS, ""], object)[np.minimum(rows["code"], len(PACKED_EVENTS))]
    at = pa.array(np.where(timely, rows["at"], 0).astype(np.int64), pa.timestamp("ms"))
    cents = pa.array(rows["cents"].astype(np.int64))
    amount = pc.cast(pc.divide(pc.cast(cents, pa.float64()), 100.0), pa.string())
    text = pc.binary_join_element_wise(
        '{"EventID":"', pa.array(names, pa.string()), '","LoginID":"u', pc.cast(pa.array(rows["user"].astype(np.int64)), pa.string()),
        '","Time":"', pc.strftime(at, "%Y-%m-%d %H:%M:%S"), '","Amount":', amount, "}", "")
    reason = pc.if_else(pa.array(known), pc.if_else(pa.array(timely), pa.scalar(None, pa.string()), pa.scalar("time out of range")), pa.scalar("unknown event code"))
    place = pc.if_else(fits, pc.subtract(pc.cumulative_sum(pc.cast(fits, pa.int64())), 1), pa.scalar(None, pa.int64()))
    length = pc.binary_join_element_wise(f"{PACKED.itemsize} bytes expected, found ", pc.cast(size, pa.string()), "")
    return pc.if_else(reason.is_null(), text, pa.scalar(None, pa.string())).take(place), pc.if_else(fits, reason.take(place), length)


register_batch_converter("packedEvent", packed_event)
