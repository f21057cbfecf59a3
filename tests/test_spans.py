"""The span relation against a plain search, and its choice against the extraction."""

import random
import re

from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.patterns import compile_pattern
from posofold.functions.stream import encode
from posofold.operators.elements import ELEMENTS, KEYS
from posofold.operators.extract import extract_elements
from posofold.operators.spans import spans, tags

SEP = "[ \x01]"
PIECES = [
    "take", "to be taken", "2 sprays", "spray", "1 tablet", "2 to 3 tablets", "3 times a day", "once a day", "every 2 hours",
    "for 5 days", "up to 4 times a day", "at night", "2 hours before food", "to be taken twice", "5mg", "from 01.02.2024 to 03.02.2024",
    "on monday", "1 or 2", "not more than 4 tablets in 1 day", "x", "10 ml", "up to a maximum of 8 tablets per day", "and", "over 10 minutes",
]


def texts(n=150, seed=3):
    r = random.Random(seed)
    return ["", "x", "2 sprays to be taken 3 times a day"] + [" ".join(r.choice(PIECES) for _ in range(r.randrange(1, 7))) for _ in range(n)]


def plain(tokens):
    """(hits, chosen) of one encoded text; hits as (start, priority, rank, size, element, pattern)."""
    hits = []
    begins = [m.end() for m in re.finditer(SEP, tokens)]
    for priority, e in enumerate(ELEMENTS):
        for rank, p in enumerate(e.patterns):
            for at in begins:
                m = re.compile(f"(?:{p.plain})(?={SEP})").match(tokens, at)
                if m:
                    before, inside = (len(re.findall(SEP, x)) for x in (tokens[:at], m.group()))
                    hits.append((before, priority, rank, inside + 1, e.key, p.name))
    dual = re.compile(rf"(?:{compile_pattern('<QTY> ' + '|'.join(vocab.VERB_OR_UNIT))})(?={SEP})")
    duals = [(len(re.findall(SEP, tokens[:at])), -1, 0, 2, "doseQuantity", "units") for at in begins if dual.match(tokens, at)]
    chosen = []

    def free(h):
        return all(h[0] + h[3] <= c[0] or c[0] + c[3] <= h[0] for c in chosen)

    direct = [h for h in hits if h[4] == "methodDirect"]
    first = min([*direct, *duals], default=None)
    if first:
        chosen.append(first)
    roles = ["methodPassive"]
    if first and first[1] >= 0:
        roles += ["frequencyWithMethod", "whenWithMethod"]
    done = min([h for h in hits if h[4] in roles and free(h)], key=lambda h: (h[0], h[4] == "methodPassive", h), default=None)
    if done:
        chosen.append(done)
    for h in sorted(hits, key=lambda h: (h[1], h[0], h[2], -h[3])):
        if h[4] not in ("methodDirect", "methodPassive") and all(c[4] != h[4] for c in chosen) and free(h):
            chosen.append(h)
    return hits, chosen


def test_relation_equals_a_plain_search(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "t string")
    got = spans(df.select("t", F.col("t").alias("at")), "at").select("t", encode(F.col("t")).alias("e"), "spans").collect()
    rejected = 0
    for r in got:
        hits, chosen = plain(r["e"])
        taken = {(c[0], c[3], c[4]) for c in chosen}
        assert sorted((s["start"], s["size"], s["element"], s["pattern"]) for s in r["spans"]) == sorted((h[0], h[3], h[4], h[5]) for h in hits)
        assert {(s["start"], s["size"], s["element"]) for s in r["spans"] if s["chosen"]} == taken
        for s in r["spans"]:
            over = [c for c in chosen if c[0] < s["start"] + s["size"] and s["start"] < c[0] + c[3]]
            if s["chosen"]:
                assert s["reason"] is None and s["by"] is None
            elif any(c[4] != s["element"] for c in over[:1]):
                assert s["reason"] == "overlap" and s["by"] == over[0][4]
            else:
                assert s["reason"] == "repeat" and s["by"]
            rejected += not s["chosen"]
    assert rejected > 200


def test_choice_equals_the_extraction(spark):
    df = spark.createDataFrame([(t,) for t in texts(seed=8)], "t string").withColumn("at", F.col("t"))
    got = {r["t"]: {(s["element"], s["pattern"], s["captured"]) for s in r["spans"] if s["chosen"]} for r in spans(df, "at").collect()}
    for r in extract_elements(df, "at").collect():
        assert got[r["t"]] == {(k, r[f"{k}_pattern"], r[f"{k}_captured"]) for k in KEYS if r[f"{k}_pattern"]}


def test_null_text_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, 1), ("take 1 tablet", 2)], "at string, _n int")
    got = {r["_n"]: r for r in spans(df, "at").selectExpr("_n", "spans", f"{tags()} AS tags").collect()}
    assert got[1]["spans"] is None and got[2]["tags"] == "methodDirect doseQuantity"
