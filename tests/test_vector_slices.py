import numpy as np
import pyarrow as pa

from corpusloom.operators import vector_index as I


def test_rows_meet_the_centroids_a_few_at_a_time():
    """All rows come, in order, at most ``ROWS`` at once; empty batches give none."""
    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(a, b))], names=["id"]) for a, b in ((0, 1000), (1000, 1000), (1000, 1063), (1063, 1128))]
    seen = [b.column("id").to_pylist() for b in I._slices(iter(batches))]
    assert max(map(len, seen)) <= I.ROWS == 64 and min(map(len, seen)) > 0
    assert [i for ids in seen for i in ids] == list(range(1128))


def test_matrix_of_a_slice():
    """A slice of an Arrow batch gives its own vectors, not those of the batch."""
    batch = pa.RecordBatch.from_arrays([pa.array([[float(i), i + 0.5] for i in range(200)], pa.list_(pa.float32()))], names=["v"])
    assert [I._matrix(b.column("v"), 2)[0, 0] for b in I._slices(iter([batch]))] == [0, 64, 128, 192]
