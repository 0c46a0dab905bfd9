"""How many rounds connected components take, and what tasks shorten."""

from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from repovitals.llm import components
from repovitals.llm.components import connected_components
from repovitals.llm.minmax_hash import _confirm, _confirm_blocks


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_shortened_edges_join_the_same_nodes(held, monkeypatch):
    monkeypatch.setattr(components, "HELD", held)
    rng = np.random.default_rng(held)
    a, b = rng.integers(-60, 60, (2, 70))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    batches = [pa.RecordBatch.from_arrays([pa.array(a[i : i + 5]), pa.array(b[i : i + 5])], schema=schema) for i in range(0, 70, 5)]
    got = pa.Table.from_batches(components._shortened(iter([*batches, batches[0].slice(0, 0)])), schema)
    assert len(got) <= 70

    def roots(edges):
        root = {x: x for x in [*a.tolist(), *b.tolist()]}
        for _ in root:
            for x, y in edges:
                root[x] = root[y] = min(root[x], root[y])
        return root

    assert roots(list(zip(a.tolist(), b.tolist()))) == roots(list(zip(*(got.column(c).to_pylist() for c in "ab"))))


def test_a_chain_in_few_tasks_takes_few_rounds(spark, tmp_path):
    chain = spark.createDataFrame([(i, i + 1) for i in range(3000)], "a long, b long").coalesce(1)
    got = {r.node: r.root for r in connected_components(chain, str(tmp_path)).collect()}
    assert got == dict.fromkeys(range(3001), 0)
    assert len(list(Path(tmp_path).glob("round=*"))) <= 2


def test_confirmed_links_are_stars():
    texts = pd.DataFrame({"sid": [5, 3, 9, 1], "text": [b"a b c d e"] * 3 + [b"f g h i j"]})
    pairs = pd.DataFrame({"a": [9, 5, 9], "b": [5, 3, 1]})
    assert sorted(_confirm(4, 80)((0, 0), pairs, texts).itertuples(index=False, name=None)) == [(5, 3), (9, 3)]


def test_links_across_join_labels():
    frame = pd.DataFrame({"sid": [5, 3, 9, 1], "text": [b"a b c d e"] * 3 + [b"f g h i j"], "block": 0, "label": [50, 30, 50, 10]})
    assert _confirm_blocks(4, 80)((0, 0), frame).values.tolist() == [[50, 30]]
