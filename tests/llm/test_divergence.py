"""Divergence of sources against sums over all terms."""

import random
import re
from collections import Counter, defaultdict

from posofold.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups, frequency = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(terms)
        frequency[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in frequency[lang].items() if n >= 3]
        mine = {s: c for (x, s), c in groups.items() if x == lang}
        whole = sum(mine.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept))

        p = {s: {t: share(c, t) for t in kept} for s, c in mine.items()}
        q = {t: share(whole, t) for t in kept}
        for s in mine:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in mine if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, n) for n, (v, item) in enumerate(found, 1) if part == "pair" or n <= 200]
    return sorted(out)


def got(spark, rows):
    return sorted(map(tuple, dv.divergence(spark.createDataFrame(rows, SCHEMA)).collect()))


def corpus(n, seed, sources=6, vocabulary=60):
    r = random.Random(seed)
    names = [f"w{''.join(r.choice('abcdeé') for _ in range(4))}" for _ in range(vocabulary)]
    rows = []
    for i in range(n):
        lang, source = r.choice("xy"), f"s{min(r.randrange(sources), r.randrange(sources))}"
        lot = names[: vocabulary // 2] if lang == "x" else names[vocabulary // 3 :]
        text = " ".join(r.choice(lot).upper() if r.random() < 0.1 else r.choice(lot) for _ in range(r.randrange(30)))
        rows.append((i, text.replace(" ", r.choice([" ", ", ", "1", "\n", "_"])), lang, source))
    return rows


def test_equals_sums_over_all_terms(spark):
    rows = corpus(300, 1)
    assert got(spark, rows) == brute(rows)


def test_many_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK", 2)
    monkeypatch.setattr(dv, "SLICE", 40)
    rows = corpus(300, 2, sources=11)
    assert got(spark, rows) == brute(rows)


def test_steps_of_few_pairs(monkeypatch):
    import pyarrow as pa

    rows = [("l", s, t, p, 2, 0, 0, 0, k) for k, (s, t, p) in enumerate([("a", "x", 9), ("b", "x", 7), ("c", "x", 5), ("a", "y", 4), ("c", "y", 3)])]
    names = ["lang", "source", "term", "p", "p0", "block", "i", "j", "k"]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    whole = dv._common(table).to_pylist()
    monkeypatch.setattr(dv, "STEP_PAIRS", 1)
    assert dv._common(table).to_pylist() == whole and whole


def test_odd_rows(spark):
    rows = corpus(40, 3, sources=2)
    rows += [(None, "alpha beta", None, None), (None, "Alpha", None, "s"), (5, "ALPHA 7 gamma", "", "t"), (5, None, "", "t")]
    rows += [(7, "", "z", "only"), (8, None, "z", "other"), (9, "once", "z", "third")]  # a lang without kept terms
    rows += [(10, "ÀÉ àé x Ω", "u", "a")] * 3 + [(11, "àé x y", "u", "b"), (12, "...", "u", "silent")]
    rows += [(13, "1 2 3 x-y", "one", "alone")] * 3
    rows += [(14, "long tail " * 200_000 + "end", "u", "b")]
    assert got(spark, rows) == brute(rows)


def test_a_source_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(dv, "SLICE", 50)
    rows = [(i, t, "x", "hot" if i % 3 == 0 else s) for i, t, _, s in corpus(240, 4, sources=20)]
    rows += [(i, "of", "x", "hot") for i in range(100)]
    assert got(spark, rows) == brute(rows)


def test_no_more_than_200_terms(spark):
    words = [f"a{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(500)]
    rows = [(i, " ".join(words[i % 2 :: 2]), "x", f"s{i % 2}") for i in range(6)]
    assert got(spark, rows) == brute(rows)


def test_empty_and_clashing_columns(spark):
    assert got(spark, []) == []
    names = ["term", "n", "docs", "p", "q", "value", "rank", "item", "part", "block"]
    rows = corpus(30, 5)
    wide = spark.createDataFrame([(*x, *names) for x in rows], f"{SCHEMA}, " + ", ".join(f"{n} string" for n in names))
    assert sorted(map(tuple, dv.divergence(wide).collect())) == brute(rows)
