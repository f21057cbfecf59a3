"""The toxicity classifier: held-out accuracy, and scores against a plain network."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from posofold.llm import toxicity as tx

SCHEMA = "doc_id long, text string, lang string, source string"
LANGS = {"x": ("bada", "goro", "mulu", "teki", "sona"), "y": ("fenz", "wirk", "host", "lemd", "garb")}
STEMS = {"x": ("vulga", "scumo"), "y": ("idjot", "trazh")}


def corpus(n, seed, share=0.4):
    """Documents of two made-up languages; toxic ones hold stems with endings that vary."""
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = "xy"[i % 2]
        words = ["".join(r.choice(LANGS[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(8, 60))]
        toxic = int(r.random() < share)
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(STEMS[lang]) + "".join(r.choice("aeiou") for _ in range(3)))
        docs.append((i, r.choice([" ", ", "]).join(words).capitalize(), lang, "s"))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def net():
    docs, labels = corpus(600, 1)
    columns = [[d[1] for d in docs], [d[2] for d in docs], [x[2] for x in labels]]
    return tx.train_on(pa.table(dict(zip(["text", "lang", "toxic"], columns))))


def plain(net, text):
    """The score of one text, word by word."""
    words = [w for w in "".join(c if c.isalpha() else " " for c in text.lower()).split()]
    rows = []
    for w in words:
        f = tx.featured(pa.array([w]))
        rows.append(sum(net.table[b].astype(float) for b in f.bucket) / math.sqrt(len(f.bucket)))
    rows += [np.zeros(tx.DIM)] * 2
    best = []
    for width, filters, bias in zip(tx.WIDTHS, net.filters, net.bias):
        for k in range(tx.FILTERS):
            values = [sum(rows[i + o] @ filters[o, :, k] for o in range(width)) + bias[k] for i in range(len(words))]
            best.append(max([0.0, *values]))
    z = float(np.dot(best, net.weight) + net.base)
    threshold = net.common
    if words and net.langs:
        fit = [sum(net.word_logs[tx.featured(pa.array([w])).own[0], k] for w in words) for k in range(len(net.langs))]
        threshold = net.thresholds[int(np.argmax(fit))]
    return 1 / (1 + math.exp(-(z - threshold + math.log(0.7 / 0.3))))


def test_scores_equal_a_plain_network(net):
    texts = [d[1] for d in corpus(40, 7)[0]] + ["", "a", "42 !", "Ünïcode wörds scumo", "x" * 5000]
    expected = [plain(net, t) for t in texts]
    assert np.allclose(net.scores(pa.array(texts)), expected, atol=1e-3)


def test_blocks_and_neighbours_change_nothing(net, monkeypatch):
    texts = [d[1] for d in corpus(60, 8)[0]] + ["", None]
    whole = net.scores(pa.array(texts))
    assert np.allclose(np.concatenate([net.scores(pa.array([t], pa.string())) for t in texts]), whole, atol=1e-5)
    monkeypatch.setattr(tx, "_BLOCK", 7)
    assert np.allclose(net.scores(pa.array(texts)), whole, atol=1e-5)


def test_one_threshold_for_each_language(net):
    assert net.langs == ["x", "y"] and len(net.thresholds) == 2


def test_threshold_is_where_f1_is_highest():
    z, toxic = np.array([5.0, 4.0, 3.0, 2.0, 1.0]), np.array([1, 1, 0, 1, 0])
    cut = tx._threshold(z, toxic)
    f1 = [2 * toxic[z >= c].sum() / ((z >= c).sum() + toxic.sum()) for c in z]
    assert 2 * toxic[z >= cut].sum() / ((z >= cut).sum() + toxic.sum()) == max(f1)
    tied = np.array([1.0, 1.0, 1.0])
    assert tx._threshold(tied, np.array([1, 0, 0])) < 1.0


def test_held_out_documents(spark):
    docs, labels = corpus(900, 2)
    got = tx.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    toxic = {i: t for i, _, t in labels}
    unseen = [r for r in got if r.held_out]
    right = sum(r.predicted == toxic[r.doc_id] for r in unseen)
    assert len(unseen) > 200 and right / len(unseen) > 0.95


def test_neither_lang_nor_source_nor_held_out_labels_matter(spark):
    docs, labels = corpus(300, 3)
    first = {r.doc_id: r.score for r in tx.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = {i for i in first if zlib.crc32(str(i).encode()) % 3 == 1}
    docs = [(i, t, "other" if i in held else x, f"s{i}") for i, t, x, _ in docs]
    labels = [(i, 0, 1 - t if i in held else t) for i, _, t in labels]
    again = {r.doc_id: r.score for r in tx.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert first.keys() == again.keys() and all(abs(first[i] - again[i]) < 1e-5 for i in first)


def test_odd_rows(spark):
    docs, labels = corpus(200, 4)
    docs += [(None, "scumo vulga", "x", "s"), (900, None, "x", "s"), (901, "", None, None), (902, "scumoaei " * 100_000, "x", "s")]
    docs += [(3, docs[3][1], "x", "s")] * 30 + [(903, "...", "x", "s")]
    names = ["score", "predicted", "held_out", "lot", "toxic", "s"]
    wide = spark.createDataFrame([(*d, *names) for d in docs], f"{SCHEMA}, " + ", ".join(f"{n} string" for n in names))
    marks = labels + [(None, 1, 1), (5, 1, None), (6, 1, 1 - labels[6][2]), (7, 1, 9), (8, 1, labels[8][2])]
    got = tx.toxicity(wide, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    empty = {round(r.score, 6) for r in got if r.doc_id in (900, 901, 903)}
    assert len(empty) == 1 and all(0 <= r.score <= 1 for r in got)
    assert len({round(r.score, 5) for r in got if r.doc_id == 3}) == 1


def test_nothing_to_learn_from(spark):
    docs, labels = corpus(12, 5)
    frame = spark.createDataFrame(docs, SCHEMA)
    for marks in ([], [(i, 1, 1) for i, _, _ in labels]):
        got = tx.toxicity(frame, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == 12 and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    empty = tx.toxicity(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert empty.collect() == []


def test_the_sample_is_bounded(spark, monkeypatch):
    docs, labels = corpus(400, 6)
    sizes = []
    monkeypatch.setattr(tx, "train_on", lambda table: sizes.append((table.num_rows, sum(len(t) for t in table.column("text").to_pylist()))))
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(tx, "SAMPLE_DOCS", 40)
    tx.train(*frames)
    monkeypatch.setattr(tx, "SAMPLE_DOCS", 3000)
    monkeypatch.setattr(tx, "SAMPLE_BYTES", 10_000)
    tx.train(*frames)
    assert 40 <= sizes[0][0] <= 120 and 4_000 < sizes[1][1] < 20_000


def test_all_labelled_texts_are_learned_from(spark, monkeypatch):
    docs, labels = corpus(500, 9)
    longest = max(i for i, _, t in labels if t and zlib.crc32(str(i).encode()) % 3 != 1)
    docs = [(i, text + " goro" * 20_000 if i == longest else text, x, s) for i, text, x, s in docs]
    for name, value in (("SAMPLE_DOCS", 5), ("SAMPLE_BYTES", 1000), ("SAMPLE_LONGEST", 100)):
        monkeypatch.setattr(tx, name, value)
    fitted, calibrated, start, cut = [], [], tx._start, tx._cut
    monkeypatch.setattr(tx, "_start", lambda seen, texts: fitted.append((seen, texts)) or start(seen, texts))
    monkeypatch.setattr(tx, "_cut", lambda n, hits, low, high: calibrated.append((n.sum(), hits.sum())) or cut(n, hits, low, high))
    tx.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    mine = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = sum(labels[i][2] for i in mine)
    (seen, texts), = fitted
    assert sum(texts) + calibrated[0][0] == len(mine) and texts[1] + calibrated[0][1] == toxic
    assert min(texts) > 50 and calibrated[0][0] > 50
    # the counts are those of the texts one by one, the long one among them
    ids = spark.createDataFrame([(i,) for i in mine], "doc_id long").selectExpr("doc_id", f"pmod(xxhash64(doc_id, {tx.SEED}), 4) = 3 AS spared")
    rows = [r.doc_id for r in ids.collect() if not r.spared]
    expected = np.zeros((2, tx.BUCKETS), int)
    for i in rows:
        words = {w for w in "".join(c if c.isalpha() else " " for c in docs[i][1].lower()).split()}
        expected[labels[i][2]] += np.bincount(tx.featured(pa.array(sorted(words))).bucket, minlength=tx.BUCKETS)
    assert (seen == expected).all()


def test_several_shards(spark, monkeypatch):
    docs, labels = corpus(900, 10)
    monkeypatch.setattr(tx, "SHARD_BYTES", 20_000)
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [r for r in tx.toxicity(*frames).collect() if r.held_out]
    toxic = {i: t for i, _, t in labels}
    assert sum(r.predicted == toxic[r.doc_id] for r in got) / len(got) > 0.95
    again = {r.doc_id: r.score for r in tx.toxicity(frames[0].repartition(3), frames[1].repartition(2)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-5 for r in got)


def test_a_trainer_goes_on_from_its_own_rows():
    net = tx._start(np.ones((2, tx.BUCKETS)), (3, 4))
    one, two = tx._Trainer(net, 0.4), tx._Trainer(tx._start(np.ones((2, tx.BUCKETS)), (3, 4)), 0.4)
    docs, labels = corpus(40, 11)
    coded, row = tx._words(pa.array([d[1] for d in docs]))
    toxic = np.array([x[2] for x in labels])
    one.learn(tx.featured(coded.dictionary), coded.indices.to_numpy().astype(np.int64), row, toxic, np.arange(40), np.random.default_rng(1))
    two.take(_means(one.rows()))
    assert np.allclose(one.net.table, two.net.table) and np.allclose(one.table.sum, two.table.sum)
    assert all(np.allclose(a, b) for x, y in zip(one._dense(), two._dense()) for a, b in zip(x, y))
    assert abs(one.net.base - two.net.base) < 1e-6 and np.allclose(one.base.sum, two.base.sum)


def _means(rows):
    values = [pa.array(rows.column(c).to_numpy() / tx._UNIT, pa.float32()) for c in tx._VALUES]
    return pa.table([rows.column("at"), *values], names=["at", *tx._VALUES])
