"""What a task of the gzip round trip holds."""

import pyarrow as pa

from polarscan.queries import volumes


def test_round_trip_leaves_in_small_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1, 1001)), pa.array([b"x" * n for n in range(1000)])], names=["doc_id", "data"])
    got = list(volumes._gzip_round(iter([batch])))
    assert max(b.num_rows for b in got) <= volumes.GZIP_ROWS
    plain = [x for b in got for x in b.column(1).to_pylist()]
    assert plain == [b"" if i % 4 == 0 else b"x" * (i - 1) for i in range(1, 1001)]
