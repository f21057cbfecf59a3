"""Every pattern, route and abbreviation has a row of an independent corpus."""

from posofold import vocab
from posofold.operators.elements import ELEMENTS
from posofold.sources import readings, templates


def test_every_pattern_has_a_row():
    seen = {(k.removesuffix("_pattern"), v) for b in templates.blocks() for k, v in b.items() if k.endswith("_pattern")}
    seen |= {tuple(part.strip() for part in hit.split(" | ")[:2]) for b in readings.blocks() for hit in b["hit"]}
    assert {(e.key, p.name) for e in ELEMENTS for p in e.patterns} <= seen


def test_every_route_and_abbreviation_has_a_row():
    assert {r[0] for r in vocab.ROUTES} == {w for w, _ in readings.words("route")}
    assert {a for a, _ in vocab.LATIN} == {w for w, _ in readings.words("latin")}
    assert len(readings.words("purpose")) > 90
