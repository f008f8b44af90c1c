"""Arrow tables as compressed values of a (bucket, data) DataFrame, so that shuffles move few, dense rows."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

BLOCKS = "bucket long, data binary"
_OPTIONS = pa.ipc.IpcWriteOptions(compression="zstd")


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_OPTIONS) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(values: Iterable[bytes], schema: pa.Schema) -> pa.Table:
    """All tables in ``values`` as one; ``schema`` is that of no value at all."""
    tables = [pa.ipc.open_stream(v).read_all() for v in values]
    return pa.concat_tables([schema.empty_table(), *tables]).combine_chunks()


def split_by(bucket: np.ndarray, table: pa.Table) -> pa.Table:
    """The rows of ``table`` as one packed block per bucket, in their order."""
    order = np.argsort(bucket, kind="stable")
    present, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    table = table.take(pa.array(order))
    data = [pack(table.slice(a, b - a)) for a, b in zip(starts.tolist(), ends.tolist())]
    return pa.table({"bucket": pa.array(present, pa.int64()), "data": pa.array(data, pa.binary())})


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of 64-bit hashes, by their upper half."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
