import random
import re
import tracemalloc
from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from posofold.llm import packing, secrets
from tests.llm import brute

DATA = "/root/testdata/sf0.001"
KEY = "0123456789abcdef" * 2 + "deadbeef"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]
    long = [t for t in texts if len(t) > 900]
    texts += ["12 34", "", None, long[0] + " ", long[1] + " one more", f'The of and token = "{KEY}" in the that with', "the and of that with"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages_equal_a_plain_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "language":
            kept = {i: t for i, t in kept.items() if t and re.search(r"[^\W\d_]", t)}
        elif name == "exact_copies":
            verdict = brute.exact(list(kept.items()))
            kept = {i: t for i, t in kept.items() if verdict[i][2]}
        elif name == "near_copies":
            verdict = brute.jaccard(list(kept.items()))
            kept = {i: t for i, t in kept.items() if verdict[i][1] == i}
        else:
            kept = {i: re.sub(r'(token = ")[0-9a-f]{40}"', r'\1[SECRET]"', t) for i, t in kept.items()}
        rows = docs.collect()
        assert {r["doc_id"]: r["text"] for r in rows} == kept, name
        docs = spark.createDataFrame(rows, docs.schema)
    assert all(r["n_chars"] == len(r["text"]) for r in rows if "[SECRET]" in r["text"])
    pieces = corpus_pipeline.run(spark, folder).collect()
    ids, count = packing.token_ids(pa.array(list(kept.values())), corpus_pipeline.TOKENIZER)
    got = {}
    for r in pieces:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == dict(zip(kept, np.array(count).tolist()))


def _docs(spark, rows):
    kind = "doc_id long, text string, lang string, source string, n_chars long, row string, group string"
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", "g") for i, t in rows], kind)


def test_no_text_is_lost_with_a_repeated_doc_id(spark, folder):
    words = [f"w{n}" for n in range(60)]
    a, b, c = " ".join(words[:40]), " ".join(words[20:]), " ".join(reversed(words))
    near = a + " more"
    rows = [(2, a), (5, a), (5, b), (1, c), (1, c), (1, c), (None, c + " "), (None, "alone and unnamed"), (None, "alone  and unnamed"),
            (7, near), (5, "short"), (8, None), (8, ""), (9, " ")]
    docs = _docs(spark, rows)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.exact_copies(spark, docs, folder).collect()), key=str)
    want = [(2, a), (5, b), (None, c + " "), (None, "alone  and unnamed"), (7, near), (5, "short"), (9, " ")]
    assert got == sorted(want, key=str)
    left = _docs(spark, got)
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, left, folder).collect()), key=str)
    assert kept == sorted([x for x in want if x != (7, near)], key=str)
    same = _docs(spark, [(3, a), (3, a + " end"), (None, a), (4, None), (None, None)])
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, same, folder).collect()), key=str)
    assert len(kept) == 3 and kept[0][0] == 3 and [x for x in kept if x[1] is None] == [(4, None), (None, None)]


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def _most(rows) -> tuple[int, int]:
    """Rows out, and bytes in use at most meanwhile."""
    tracemalloc.start()
    n = sum(b.num_rows for b in rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, most


def _batch(n: int) -> pa.RecordBatch:
    r = random.Random(5)
    texts = [" ".join(f"{r.choice('abcdef')}{r.randrange(3000)}" for _ in range(400)) for _ in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts), pa.array([None] * n, pa.string())], ["doc_id", "text", "source"])


def test_memory_of_windows_does_not_grow_with_the_batch(monkeypatch):
    """The stage's settings work a batch of 4 MB off in steps."""
    seen = {}
    monkeypatch.setattr(packing, "pack", lambda docs, path, **given: seen.update(given))
    corpus_pipeline.windows(None, None, "")
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(packing, "_tokenizers", {})
    work = packing._packer(corpus_pipeline.TOKENIZER, packing.TIERS, False, seen["cache"], seen["step"])
    assert sum(b.num_rows for b in work(iter([_batch(1)])))  # the vocabulary is there
    n, most = _most(work(iter([_batch(2000)])))
    assert n >= 2000 and most < 48 << 20, most


def test_memory_of_secrets_does_not_grow_with_the_batch():
    forest = secrets.train(secrets.labelled_findings(n=200))
    work = secrets._scanner(SimpleNamespace(value=forest), secrets.THRESHOLD)
    n, most = _most(work(iter([_batch(2000)])))
    assert n == 2000 and most < 3 << 20, most
