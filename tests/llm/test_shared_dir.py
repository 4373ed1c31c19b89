"""Only a local session may do without a shared folder; batches handed to Python are bounded."""

from types import SimpleNamespace

import pyarrow as pa
import pytest

from ordertide.llm import common
from ordertide.llm.common import bounded, shared_dir


def _session(master):
    settings = {}
    conf = SimpleNamespace(get=settings.get, set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_a_cluster_needs_a_shared_folder():
    assert shared_dir(_session("local[2]"))
    with pytest.raises(ValueError):
        shared_dir(_session("spark://host:7077"))


def test_batches_are_cut_and_keep_their_rows(monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 1000)
    rows = [b"x" * n for n in (10, 5000, 0, 300, 300, 300, 300, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows), pa.array(range(8))], names=["a", "b"])
    empty = batch.slice(0, 0)
    found = list(bounded(lambda batches: batches)(iter([batch, empty, batch.slice(2, 1)])))
    assert [x for b in found for x in b.column(0).to_pylist()] == [*rows, b""]
    assert len(found) > 4 and any(b.num_rows == 0 for b in found)
