import hashlib
import random

import numpy as np
import pytest
import xxhash

from posofold.llm import line_dedup as ld
from tests.llm import brute


def _slow_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_equal_the_table():
    rng = random.Random(8)
    for _ in range(300):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(90)))
        b = "".join(c for c in a if rng.random() < 0.9) if rng.random() < 0.5 else "".join(rng.choice("abc ") for _ in range(rng.randrange(90)))
        assert ld.edits(a, b) == _slow_edits(a, b)


def _sim(words):
    votes = np.zeros(64)
    for w in set(words):
        raw = xxhash.xxh3_64_intdigest(w)
        votes += [1 if raw >> (8 * (i // 8) + 7 - i % 8) & 1 else -1 for i in range(64)]
    return sum(1 << i for i in range(64) if votes[i] > 0)


def _brute(docs):
    where, out = {}, {}
    for doc_id, text in docs:
        for i, line in enumerate([] if text is None else text.split("\n")):
            normal = ld.normalised(line)
            if len(normal.split()) >= ld.MIN_WORDS:
                where.setdefault(normal, []).append((doc_id, i))
    sims, keys = {x: _sim(x.split()) for x in where}, sorted(where)
    links = [
        (a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]
        if (sims[a] ^ sims[b]).bit_count() <= ld.DISTANCE and max(len(a), len(b)) - ld.edits(a, b) >= ld.SIMILARITY * max(len(a), len(b))
    ]
    group = brute.components(keys, links)
    places = {}
    for x, found in where.items():
        places.setdefault(group[x], []).extend(found)
    gone = {p for found in places.values() for p in found} - {min(found) for found in places.values()}
    for doc_id, text in docs:
        lines = [] if text is None else text.split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if (doc_id, i) not in gone)
        out[doc_id] = (len(lines), sum((doc_id, i) in gone for i in range(len(lines))), hashlib.sha256(kept.encode()).hexdigest())
    return out, len(links)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()][:90]
    lines = [x for t in texts for x in t.split("\n") if len(x.split()) > 25][:25]
    for line in lines:
        w = line.split()
        for _ in range(4):
            v = list(w)
            v[rng.randrange(len(v))] += rng.choice(["s", ".", "", "x"])
            texts.append("\n".join(["short", " ".join(v), line.upper(), "", rng.choice(lines)]))
    texts += [None, "", "\n", "a b c d e\nA, b c d e!\na b c d f", "no 12 of 34 is 5 x\nno 98 of 76 is 5 x\nfour words are few\nfour words are few"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_equals_brute_force(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_sha256"]) for r in ld.without_repeated_lines(df).collect()}
    want, links = _brute(docs)
    assert got == want and links > 20


def test_odd_rows(spark):
    line = "one two three four five six"
    rows = [(1, line, 1), (1, line, 1), (2, f"{line}\n{line}.\nx", 2), (None, line, 3), (None, None, 4), (3, "", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, line int")
    got = sorted((r["doc_id"] or -1, r["n_lines"], r["n_removed"], r["kept_text"]) for r in ld.without_repeated_lines(df).collect())
    assert got == [(-1, 0, 0, ""), (-1, 1, 0, line), (1, 1, 0, line), (1, 1, 0, line), (2, 3, 2, "x"), (3, 1, 0, "")]
    assert ld.without_repeated_lines(df.limit(0)).count() == 0


def test_short_lines_and_lines_without_spaces_are_settled(spark):
    rng = random.Random(6)
    pool = ["Home", "Read more", "read  MORE!", "About us |", "All 12 items", "All 34 items", "日本語の行です", "ข้อความ", "one two three four", "---", "", "  "]
    docs = [(i, "\n".join([*rng.choices(pool, k=6), hashlib.sha256(bytes([i])).hexdigest()])) for i in range(40)]
    seen, want = set(), {}
    for doc_id, text in docs:
        kept = []
        for line in text.split("\n"):
            words = [w.strip("|!-") for w in "".join("0" if c.isdigit() else c for c in line.lower()).split()]
            key = " ".join(w for w in words if w)
            if not key or key not in seen:
                kept.append(line)
            seen.add(key)
        want[doc_id] = "\n".join(kept)
    got = ld.without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["kept_text"] for r in got} == want
