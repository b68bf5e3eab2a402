"""What the text operators hold at once, and what worker processes remember."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tallybook.llm import alignment, shared
from tallybook.llm.near_copies import _sets
from tallybook.llm.packing import pack_texts
from tallybook.llm.tokenizing import encoder


def test_links_are_looked_up_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 100)
    sizes = [0, 60, 40, 1, 0, 300, 0, 99, 2, 0]
    links = pa.array([list(range(n)) for n in sizes], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), links], ["id", "links"])
    # a batch that is a slice itself begins inside its arrays
    for whole in (batch, batch.slice(1), batch.slice(4, 3)):
        parts = list(alignment.chunks(whole, whole.column(1)))
        assert [x for p in parts for x in p.column(0).to_pylist()] == whole.column(0).to_pylist()
        assert all(p.num_rows == 1 or len(p.column(1).flatten()) <= 100 for p in parts)
        codes = np.arange(300, dtype=np.int32)
        found = [alignment.link_sums(p.column(1), codes, (codes % 2 == 0, codes * 3)) for p in parts]
        for i, value in enumerate((lambda x: x % 2 == 0, lambda x: 3 * x)):
            wanted = [sum(map(value, row)) for row in whole.column(1).to_pylist()]
            assert [x for sums in found for x in sums[i].to_pylist()] == wanted
    assert list(alignment.chunks(batch.slice(0, 0), batch.slice(0, 0).column(1))) == []


def test_units_that_come_again_outlast_a_full_memory(monkeypatch):
    monkeypatch.setattr(alignment, "UNITS", 100)
    asked = []

    def compute(units):
        asked.extend(units)
        return {u: u.upper() for u in units}

    recent = alignment.Recent(compute)
    long = "x" * (alignment.LONGEST + 1)
    for i in range(50):
        units = ["often", f"a{i}", f"b{i}", f"c{i}", "often"]
        assert recent.of(units) == [u.upper() for u in units]
        assert len(recent._known) <= 100 and len(recent._older) <= 100
    assert asked.count("often") == 1 and len(asked) == 151
    many = [f"m{i}" for i in range(300)]
    assert recent.of(many) == [u.upper() for u in many]
    assert recent.of([long, "often"]) == [long.upper(), "OFTEN"] and long not in recent._known


def test_a_worker_remembers_for_one_step_at_a_time(monkeypatch):
    monkeypatch.setattr(shared, "_begun", {})
    dropped = []
    for step in ("a", "a", "b", "b", "a"):
        shared.begin_step(step, lambda s=step: dropped.append(s))
    assert dropped == ["a", "b"]


def test_the_next_step_drops_the_lengths_that_packing_remembers(spark):
    def left(texts: pd.Series) -> pd.Series:
        _sets(texts)
        return pd.Series([encoder.cache_info().currsize] * len(texts))

    docs = spark.createDataFrame([(i, f"word{i} and others", "s") for i in range(40)], "doc_id long, text string, source string")
    assert pack_texts(docs).count() == 40
    assert {r[0] for r in docs.select(F.pandas_udf(left, "long")("text")).collect()} == {0}
