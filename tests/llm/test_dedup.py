import math
import random

import pytest

from posofold.llm import embed_join, exact_dedup, substring
from tests.llm import brute

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Real documents, and passages, copies and odd texts put in between."""
    rng = random.Random(3)
    texts = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]
    passage = " ".join(f"w{i}" for i in range(60))
    texts += [f"{a} {passage} {b}" for a, b in zip(texts[:20], texts[20:40])]
    texts += [" ".join(rng.choice(["a", "b"]) for _ in range(400)) for _ in range(5)]
    texts += ["Is onhe. " * 300, "Is onhe. " * 40, None, "", " \n", "x", passage, passage, passage[:-4], "\x0b" + passage]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def table(spark, docs):
    rows = [(i, t, "en", "s", 1) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_substring_equals_brute_force(table, docs):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.without_repeats(table).collect()}
    assert got == brute.substring(docs)


def test_repeats_are_maximal_and_cover_what_is_removed(table, docs):
    spans = substring.repeats(table).collect()
    by = {}
    for r in spans:
        assert r["end"] - r["start"] >= substring.LENGTH
        by.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    want = {i: n for i, (_, n, _) in brute.substring(docs).items() if n}
    assert {i: sum(b - a for a, b in s) for i, s in by.items()} == want
    for s in by.values():
        s.sort()
        assert all(a[1] < b[0] for a, b in zip(s, s[1:]))


def test_substring_odd_rows(spark):
    words = " ".join(map(str, range(30)))
    rows = [(1, words, 1), (1, words, 2), (2, words, 3), (None, words, 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found int")
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in substring.without_repeats(df).collect())
    assert got == [(-1, 0, 0), (-1, 30, 0), (1, 30, 0), (1, 30, 0), (2, 30, 30)]
    assert substring.without_repeats(df.limit(0)).count() == 0


def test_exact_equals_brute_force(table, docs):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(table).collect()}
    assert got == brute.exact(docs)


def test_exact_odd_rows(spark):
    rows = [(1, "a b", 1), (1, "a b", 1), (2, "ab", 2), (3, "ab ", 3), (None, "ab  ", 4), (None, "z", 5), (4, None, 6), (5, " ", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run int")
    out = exact_dedup.exact_dedup(df).collect()
    got = sorted(((r["doc_id"] or -1), r["keep_id"], r["group_size"], r["kept"]) for r in out)
    want = [(-1, None, 1, True), (-1, None, 5, True), (1, None, 5, False), (1, None, 5, False), (2, None, 5, False)]
    assert got == [*want, (3, None, 5, False), (4, 5, 2, False), (5, 5, 2, True)]
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def _vectors(rng):
    rows = []
    for c in range(12):
        centre = [rng.gauss(0, 1) for _ in range(16)]
        for _ in range(25):
            spread = rng.choice([0.05, 0.2, 0.3])
            rows.append(([x + rng.gauss(0, spread) for x in centre], c % 4))
    rows += [([0.0] * 16, 1), (None, 1), ([], 1), ([math.nan] * 16, 1), ([math.inf] + [1.0] * 15, 1), ([1.0, None] * 8, 1)]
    rows += [([1.0] * 16, None), ([1e300] * 16, 2), ([1e-300] * 16, 2), ([2.0] * 16, 2), ([1.0, 2.0], 2), ([2.0, 4.0], 2)]
    rng.shuffle(rows)
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [7, 4096])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embed_join, "BLOCK", block)
    monkeypatch.setattr(embed_join, "CHUNK", 3 * block)
    monkeypatch.setattr(embed_join, "CELL", 2 * block)
    rows = _vectors(random.Random(5))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_join.near_vectors(df).collect()}
    want = brute.vectors([r for r in rows if not (r[1] and abs(r[1][0] or 0) in (1e300, 1e-300))])
    odd = [i for i, v, _ in rows if v and v[0] in (1e300, 1e-300, 2.0) and len(v) == 16]
    assert {i: got[i] for i in want if i not in odd} == {i: want[i] for i in want if i not in odd}
    assert {got[i] for i in odd} == {(2, min(odd))}


def test_vectors_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label int, cell int, dim string"
    rows = [(1, [1.0, 0.0], 1, 1, "x"), (1, [1.0, 0.0], 1, 2, "x"), (2, [1.0, 0.0], 1, 2, "x"), (None, [1.0, 0.0], 1, 3, None)]
    df = spark.createDataFrame(rows, kind)
    got = sorted(((r["vec_id"] or -1), r["n_links"], r["component_id"]) for r in embed_join.near_vectors(df).collect())
    assert got == [(-1, 0, None), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert embed_join.near_vectors(df.limit(0)).count() == 0


def test_rows_that_repeat_a_vec_id_are_all_compared(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (3, [0.0, 1.0], 1), (9, [1.0, 0.01], 1), (9, [1.0, 0.0], 2), (7, [-1.0, 0.0], 1), (5, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in embed_join.near_vectors(df).collect())
    # the two vectors of 5 tie those of 3 and 9 together
    assert got == sorted([(5, 1, 3, False), (5, 1, 3, False), (5, 0, 3, False), (3, 1, 3, True), (9, 1, 3, False), (9, 0, 3, False), (7, 0, 7, True)])
