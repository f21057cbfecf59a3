import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from posofold.llm import ngram_join
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def _edited(rng, text, share):
    w = text.split(" ")
    for _ in range(max(1, int(len(w) * share))):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    texts = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]
    base = [t for t in texts if len(t) > 600][:12]
    texts += [_edited(rng, t, s) for t in base for s in (0.003, 0.01, 0.02, 0.03, 0.04)]
    passage = " ".join(f"w{i}" for i in range(80))
    texts += [f"{' '.join(str(rng.random()) for _ in range(rng.randrange(10, 60)))} {passage}" for _ in range(40)]
    chain = [str(rng.random()) for _ in range(200)]
    texts += [" ".join(chain[i * 12 : i * 12 + 100]) for i in range(8)]
    texts += [" ".join("ab"[rng.random() < 0.5] for _ in range(60)) for _ in range(10)]
    texts += [None, "", " ", "One two", "one TWO", "one two three", "É é", "é é", "a b c d e", "A b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("tile", [3, 1024])
def test_equals_brute_force(spark, docs, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_documents(df).collect()}
    assert got == brute.jaccard(docs)


def test_odd_rows(spark):
    rows = [(1, "a b c", 1), (1, "a b c", 2), (1, "x y", 0), (2, "A B C", 3), (None, "a b c", 4), (3, None, 5), (4, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, set_id int")
    got = sorted(((r["doc_id"] or -1), r["n_shingles"], r["component_id"]) for r in ngram_join.near_documents(df).collect())
    assert got == [(-1, 1, None), (1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]
    assert ngram_join.near_documents(df.limit(0)).count() == 0


def test_tree_never_loses_a_pair():
    rng = np.random.default_rng(4)
    points = rng.poisson(rng.choice([0.3, 2, 6], size=(300, 1)), size=(300, ngram_join.GROUPS)).astype(np.int32)
    points[100:160] = points[:60] + (rng.random((60, ngram_join.GROUPS)) < 0.05)
    tree, size = ngram_join.RTree(points), points.sum(axis=1)
    for i, p in enumerate(points):
        want = 7 * np.minimum(points, p).sum(axis=1) >= 3 * (size + size[i])
        assert sorted(tree.candidates(p)) == np.flatnonzero(want).tolist()


def test_memory_of_low_halves_does_not_grow_with_the_batch():
    """A batch of many texts is worked off in steps, and a set that comes back is not sent again."""
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(50_000)}" for _ in range(400)) for _ in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    sent = [b.num_rows for b in ngram_join._low_half(iter([batch, batch.slice(0, 500)]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sent) == 2500 * 198 and most < 32 << 20, (sum(sent), most)
