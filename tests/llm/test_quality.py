import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from shapes import documents, folder, odd  # noqa: F401

from tallyfold.llm import quality as q
from tallyfold.llm import queries

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = queries.op10(spark, DATA).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in judged]) > 0.95
    assert {a for a, b in judged} == {0, 1}


def test_model_learns_a_curve_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (6000, 3))
    label = ((np.abs(x[:, 0]) < 0.4) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = q.fitted(x[:5000], label[:5000])
    assert (1, 2) in model.pairs
    flat = ((np.abs(x[:, 0]) < 0.5)).astype(float)
    assert ((q.fitted(x[:5000], flat[:5000]).scores(x[5000:]) > 0.5) == flat[5000:]).mean() > 0.97
    both = ((x[:, 1] * x[:, 2] > 0)).astype(float)
    assert ((q.fitted(x[:5000], both[:5000]).scores(x[5000:]) > 0.5) == both[5000:]).mean() > 0.9


def test_a_text_is_measured_alike_wherever_it_stands():
    texts = ["One two, two three!\nFOUR 5 $", None, "", " \n", "x", "ß é", "a " * 3000]
    together = q.measures(pa.array(texts))
    alone = np.concatenate([q.measures(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(together, alone) and not together[1:4].any()
    named = dict(zip(q.FEATURES, together[0], strict=True))
    assert named["upper"] == pytest.approx(5 / 18) and named["distinct_words"] == 1
    assert dict(zip(q.FEATURES, together[6], strict=True))["repeated_next"] == pytest.approx(2999 / 3000)


def test_labels_of_one_kind_or_none():
    x = np.random.default_rng(2).normal(size=(50, len(q.FEATURES)))
    assert (q.fitted(x, np.ones(50)).scores(x) > 0.99).all()
    assert (q.fitted(x[:0], np.ones(0)).scores(x) == 0.5).all()


def test_odd_rows(spark, odd, rows, folder):
    labels = rows("doc_id long, quality int, toxic int, score double", (1, 1, 0, None), (4, 0, 0, None), (5, None, 0, None),
                  (6, 1, 0, None), (7, 0, 0, None), (8, 1, 0, None), (None, 1, 0, None))
    path = folder(documents=odd, labels=labels)
    found = queries.op10(spark, path).collect()
    assert len(found) == 12 and all(0 <= r["score"] <= 1 for r in found)
    folder(**{"none/documents": odd.limit(0), "none/labels": labels})
    assert queries.op10(spark, f"{path}/none").count() == 0


def test_held_out_labels_do_not_count(spark, odd, rows):
    measured = q.with_features(odd).select("doc_id", "features")
    held = [i for i in range(1, 10) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = rows("doc_id long, quality int", *[(i, 0 if i in held else 1) for i in range(1, 10)])
    assert held and (q.train(measured, labels).scores(np.zeros((1, len(q.FEATURES)))) > 0.99).all()
