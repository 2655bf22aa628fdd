"""op7 on many copies of a long text, all of whose lines are common."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa

from blockbeam.llm import lines as L


def test_keys_of_a_batch_are_not_held_as_objects():
    """2000 copies of a text of 250 common lines are 8 MB of keys; as dicts they took 139 MB."""
    n, each = 2000, 250
    k = np.tile(np.arange(each, dtype=np.int64), n)
    keys = pa.StructArray.from_arrays([pa.array(k), pa.array(k + 7)], names=["k1", "k2"])
    found = pa.ListArray.from_arrays(pa.array(np.arange(0, n * each + 1, each), pa.int32()), keys)
    tracemalloc.start()
    try:
        sizes = [len(x) for x in L._commons(found)]
        assert tracemalloc.get_traced_memory()[1] < 24 << 20
    finally:
        tracemalloc.stop()
    assert sizes == [each] * n


def test_keys_of_slices_and_nulls():
    kind = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64())]))
    row = lambda *v: [{"k1": x, "k2": -x} for x in v]
    found = pa.array([row(1), None, row(2, 3), [], row(4)], kind)
    want = [{np.array([x, -x], np.int64).tobytes() for x in v} for v in ((1,), (), (2, 3), (), (4,))]
    assert list(L._commons(found)) == want
    assert list(L._commons(found.slice(1, 3))) == want[1:4]
    assert list(L._commons(pa.nulls(2, kind))) == [set(), set()]


def test_copies_lose_their_lines(spark):
    text = "\n".join(f"Line {i % 300} " for i in range(400))
    rows = [(i, text) for i in range(40)] + [(100, "line 5\nown"), (101, None), (102, "")]
    out = {r["doc_id"]: r for r in L.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert all((out[i]["n_lines"], out[i]["n_dropped"], out[i]["kept_sha256"]) == (400, 400, empty) for i in range(40))
    assert (out[100]["n_lines"], out[100]["n_dropped"], out[100]["kept_sha256"]) == (2, 1, hashlib.sha256(b"own").hexdigest())
    assert all((out[i]["n_lines"], out[i]["n_dropped"]) == (1, 0) for i in (101, 102))
