"""Which keys can be repeated: a sketch of fixed size instead of a shuffle of all keys.

Nearly all keys of a table occur once, yet a plain ``GROUP BY keys HAVING
count(*) > 1`` shuffles every key. Here each row sets the bit of its hashed
key in a bitmap "seen once", or, if that is set, in a bitmap "seen twice". Map
tasks send the sorted bit positions as compressed gaps, about a byte or two a
row, by slice of the bitmap; a slice's task merges them in fixed memory. Only
rows whose bit was seen twice can have a repeated key; they alone are counted
exactly. A bitmap that fills up lets more rows through: it costs time, never
a result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a position; the bitmap has 2^BITS bits (16 MB).
BITS = 27
#: Bits of a position within a slice, which one task merges.
SLICE_BITS = 20
#: Positions that a map task holds before it sends them.
HELD = 1 << 22


def _key_hash(keys: Sequence[str], bits: int) -> Column:
    """The position of a key; NULLs are values of their own, as in GROUP BY."""
    parts = [x for k in keys for x in (F.col(k), F.col(k).isNull())]
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - bits)


def _gaps(positions: np.ndarray) -> bytes:
    """Sorted positions as compressed gaps."""
    gaps = np.diff(positions, prepend=0)
    kind = "<u2" if not len(gaps) or gaps.max() < 1 << 16 else "<u4"
    return kind[-1].encode() + zlib.compress(gaps.astype(kind).tobytes(), 6)


def _positions(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data[1:]), dtype="<u" + data[:1].decode()), dtype=np.int64)


def seen_twice(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """``slice``, ``bits``: the bitmap of key positions that two or more rows have, compressed, a row per
    slice that has one. At most 2^(bits - SLICE_BITS) rows."""
    span = 1 << min(bits, SLICE_BITS)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def rows() -> pd.DataFrame:
            at, count = np.unique(np.concatenate(held), return_counts=True)
            out = []
            for s in np.unique(at // span):
                here = (at // span) == s
                own = at[here] - s * span
                out.append((int(s), _gaps(own), _gaps(own[count[here] > 1])))
            return pd.DataFrame(out, columns=["slice", "once", "twice"])

        for batch in batches:
            held.append(batch["h"].to_numpy())
            n += len(batch)
            if n >= HELD:
                yield rows()
                held, n = [], 0
        if n:
            yield rows()

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, once, twice = None, None, None

        def row() -> pd.DataFrame:
            return pd.DataFrame({"slice": [at], "bits": [zlib.compress(np.packbits(twice).tobytes(), 1)]})

        for batch in batches:
            for s, a, b in zip(batch["slice"], batch["once"], batch["twice"]):
                if s != at:
                    if at is not None and twice.any():
                        yield row()
                    at, once, twice = s, np.zeros(span, dtype=bool), np.zeros(span, dtype=bool)
                new = _positions(bytes(a))
                twice[new[once[new]]] = True
                once[new] = True
                twice[_positions(bytes(b))] = True
        if at is not None and twice.any():
            yield row()

    sent = df.select(_key_hash(keys, bits).alias("h")).mapInPandas(send, "slice int, once binary, twice binary")
    return sent.repartition("slice").sortWithinPartitions("slice").mapInPandas(merge, "slice int, bits binary")


def split_repeated(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may occur more than once, rows whose key occurs once): the first has all that do, and few others.

    Runs the sketch as a job; the bitmap (2^bits bits at most, 16 MB) passes
    through the driver to the tasks that filter.
    """
    span = 1 << min(bits, SLICE_BITS)
    bitmap = {r["slice"]: bytes(r["bits"]) for r in seen_twice(df, keys, bits).collect()}   # bounded: 2^bits bits
    if not bitmap:
        return df.where(F.lit(False)), df
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = {s: np.unpackbits(np.frombuffer(zlib.decompress(b), dtype=np.uint8)) for s, b in shared.value.items()}
        none = np.zeros(span, dtype=np.uint8)
        slices = [ready.get(s, none) for s in range(1 << (bits - min(bits, SLICE_BITS)))]
        for h in batches:
            at = h.to_numpy()
            out = np.zeros(len(at), dtype=bool)
            for s in np.unique(at // span):
                here = (at // span) == s
                out[here] = slices[s][at[here] - s * span] > 0
            yield pd.Series(out)

    may = hit(_key_hash(keys, bits))
    return df.where(may), df.where(~may)


def maybe_repeated(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose key may occur more than once."""
    return split_repeated(df, keys, bits)[0]


def repeated_keys(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """Keys that occur more than once, with their row count: as ``quality.duplicate_keys``, but
    only rows that the sketch lets through are shuffled."""
    return (maybe_repeated(df, keys, bits).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_count"))
            .where(F.col("rows_count") > 1))
