import random
import re

import numpy as np
import pytest
import xxhash
import sentencepiece

from posofold.llm import sp_dropout
from posofold.llm.queries import PIECE_TOKENIZER

MODEL = PIECE_TOKENIZER
SEGMENT = re.compile(r" +[^ ]*|[^ ]+")
ODD = ["", " ", "  a  b ", "a▁b ▁ ▁▁x", "\x00\t\r\n", "日本語 🙂 é é", "a" * 500, "x y" * 50, "<s> </s> <0x41>", "     indented\n      more"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    return [r["text"] for r in rows]


def test_without_dropout_the_ids_are_the_library_s(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = sp_dropout.Encoder(MODEL, dropout=0.0)
    for text in texts + [t for t in ODD if "▁" not in t]:
        assert list(memoryview(encoder.encode(text)).cast("I")) == library.encode(text), text[:80]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.7, 1.0])
def test_round_trip(texts, dropout):
    encoder = sp_dropout.Encoder(MODEL, dropout)
    for text in texts[::5] + ODD:
        assert encoder.model.decode(memoryview(encoder.encode(text)).cast("I")) == text


def _plain(model, segment, dropout, key):
    """Merge by a list that is searched from start to end each time."""
    parts = [(i, c) for i, c in enumerate(segment.replace(" ", sp_dropout.MARK))]
    skipped = set()
    while True:
        best = None
        for (i, a), (j, b) in zip(parts, parts[1:]):
            found = model.rank.get(a + b)
            if found and (i, len(a), len(b)) not in skipped and (best is None or (found[0], i) < best[:2]):
                best = (found[0], i, found[1], len(a), len(b))
        if best is None:
            return [x for _, s in parts for x in ([model.id[s]] if s in model.id else [model.byte[c] for c in s.encode()])]
        _, i, piece, size, follow = best
        h = ((key ^ (i * 0x9E3779B97F4A7C15)) + piece * 0xBF58476D1CE4E5B9) % 2**64
        h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) % 2**64
        if (h >> 32) < int(dropout * 2**32):
            skipped.add((i, size, follow))
            continue
        at = next(k for k, p in enumerate(parts) if p[0] == i)
        parts[at : at + 2] = [(i, parts[at][1] + parts[at + 1][1])]


def test_agenda_equals_a_plain_search(texts):
    model, rng = sp_dropout.model(MODEL), random.Random(1)
    for segment in {s for t in texts[:40] for s in SEGMENT.findall(" " + t)}:
        key = rng.getrandbits(64)
        assert model.encode(segment, 0.3, key) == model._agenda(segment, 0.3, key) == _plain(model, segment, 0.3, key)


def test_seed_and_variant_vary_the_cuts(texts):
    text = max(texts, key=len)
    one, again, other = (sp_dropout.Encoder(MODEL, 0.1, seed).encode(text, 0) for seed in (1, 1, 2))
    assert one == again != other and one != sp_dropout.Encoder(MODEL, 0.1, 1).encode(text, 1)


def test_occurrences_are_cut_each_by_itself(texts):
    encoder, word = sp_dropout.Encoder(MODEL, 0.1), " international"
    cuts = {encoder.encode(word[1:], i) for i in range(300)}
    assert len(cuts) > 3 and encoder.encode(word[1:], 7) == sp_dropout.Encoder(MODEL, 0.1).encode(word[1:], 7)
    within = encoder.encode(word[1:] + word * 300, 1)
    whole = encoder.model.encode(word, 0.0, 0)
    assert within != within[: len(within) // 301] * 301 and len(within) // 4 > 301 * len(whole)
    for dropout in (0.1, 0.6):  # cached results equal merging with the key
        encoder = sp_dropout.Encoder(MODEL, dropout)
        for text in texts[:20] + ODD[:-3]:
            segments = SEGMENT.findall(" " + text) if text else []
            keys = sp_dropout.mix(sp_dropout.np.arange(5, 5 + len(segments), dtype=sp_dropout.np.uint64))
            want = [x for s, k in zip(segments, keys) for x in encoder.model.encode(s, dropout, int(k))]
            assert not segments or encoder._part(segments, keys)[0].tolist() == want


def test_a_text_is_its_segments_with_keys_of_their_own(texts):
    encoder = sp_dropout.Encoder(MODEL, 0.3, 7)
    for doc_id, text in enumerate([*texts[:25], *ODD]):
        segments = SEGMENT.findall(" " + text) if text else []
        base = xxhash.xxh3_64_intdigest(str(doc_id), seed=7)
        numbers = np.arange(len(segments), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(base)
        want = [x for s, k in zip(segments, sp_dropout.mix(numbers)) for x in encoder.model.encode(s, 0.3, int(k))]
        assert list(memoryview(encoder.encode(text, doc_id)).cast("I")) == want


def test_neighbours_and_steps_change_nothing(texts, monkeypatch):
    encoder = sp_dropout.Encoder(MODEL, 0.2)
    some = [*texts[:20], *ODD, None]
    together = encoder.encode_all(some, list(range(len(some))))
    monkeypatch.setattr(sp_dropout, "_STEP", 3)
    assert together == [encoder.encode(t, i) for i, t in enumerate(some)]


def test_tables(spark, texts):
    rows = [(i, t, 0) for i, t in enumerate(texts[:30] + ODD)] + [(None, None, 1), (0, texts[0], 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    back = sorted((str(r["doc_id"]), r["text"]) for r in sp_dropout.decode(sp_dropout.encode(df, MODEL), MODEL).collect())
    assert back == sorted((str(i), t or "") for i, t, _ in rows)
    out = sp_dropout.summary(df, MODEL).collect()
    assert len(out) == len(rows) and all(r["lossless"] for r in out)
    assert sp_dropout.summary(df.limit(0), MODEL).count() == 0
