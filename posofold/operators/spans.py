"""All hits of all token patterns as one relation, the greedy choice among them, and why the rest lost.

``extract_elements`` lets one element after the other claim its tokens and keeps nothing but the
winners.  Here every hit is kept: for each pattern, wherever it can begin.  One fold over the
hits, ordered by priority of the element, first token, order of its patterns and length, takes
a hit if its element has none yet and all its tokens are free.  The others keep their reason:

* ``overlap``: the element ``by`` holds some of its tokens,
* ``repeat``: the element has an earlier hit, or none may be taken (``by`` is then the element
  that the rules between methods and doses preferred).

The two rules between methods and others come first, as in the extraction: a word that is a verb
and a unit belongs to a dose behind a quantity, and with a direct method at hand "to be taken 3
times a day" is one frequency or timing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.fence import fence
from posofold.functions.patterns import compile_pattern, needs
from posofold.functions.stream import GLUE, SEP, encode
from posofold.functions.text import sql_string
from posofold.operators.elements import ELEMENTS, SHORTER_FIRST

_MARK = "\u0003"
_SPAN = "struct<priority:int,start:int,rank:int,size:int,element:string,pattern:string,hit:string>"
_DUAL = compile_pattern(f"<QTY> {'|'.join(vocab.VERB_OR_UNIT)}")


def _separators(text: str) -> str:
    """Number of separators in a piece of encoded text."""
    return f"(length({text}) - length(translate({text}, {sql_string(' ' + GLUE)}, '')))"


def _hits(tokens: str, priority: int, rank: int, element: str, pattern: str, body: str, spec: str) -> str:
    """One struct for each token at which the pattern can begin.

    A mark in front of each such token cuts the text in pieces; the separators in the pieces
    count the tokens, and a look-ahead gives the hit itself.
    """
    at = rf"(?<={SEP})(?=(?:{body}){SEP})"
    marked = f"split(regexp_replace({tokens}, {sql_string(at)}, {sql_string(_MARK)}), {sql_string(_MARK)})"
    found = f"regexp_extract_all({tokens}, {sql_string(rf'(?<={SEP})(?=({body}){SEP})')}, 1)"
    starts = (
        f"slice(aggregate({marked}, cast(array() AS array<int>), (a, x) -> concat(a, array("
        f"coalesce(try_element_at(a, -1), 0) + {_separators('x')}))), 1, size({found}))"
    )
    spans = (
        f"zip_with({starts}, {found}, (s, h) -> named_struct('priority', {priority}, 'start', s, 'rank', {rank}, "
        f"'size', {_separators('h')} + 1, 'element', {sql_string(element)}, 'pattern', {sql_string(pattern)}, 'hit', h))"
    )
    words = needs(spec)
    if not words:
        return spans
    tests = " OR ".join(f"{tokens} RLIKE '[0-9]'" if w == "0-9" else f"contains({tokens}, {sql_string(w)})" for w in words)
    return f"CASE WHEN {tests} THEN {spans} ELSE cast(array() AS array<{_SPAN}>) END"


def candidates(df: DataFrame, text: str) -> DataFrame:
    """Add ``_tokens`` and ``_hits``: every hit of every pattern."""
    df = fence(df.select("*", encode(F.col(text)).alias("_tokens")), "_tokens")
    names = []
    for priority, e in enumerate(ELEMENTS):
        for rank, p in enumerate(e.patterns):
            names.append(f"{_hits('_tokens', priority, rank, e.key, p.name, p.plain, p.tokens)} AS _h{priority}_{rank}")
    dual = _hits("_tokens", -1, 0, "doseQuantity", "units", _DUAL, "<QTY>")
    df = df.selectExpr("*", *names, f"{dual} AS _dual")
    listed = [n.rpartition(" AS ")[2] for n in names]
    df = df.select(*[c for c in df.columns if c not in {*listed, "_dual"}], F.concat(*listed).alias("_hits"), "_dual")
    return fence(df, "_hits", "_dual")


def _first(condition: str, source: str = "_hits", late: str = "") -> str:
    """The hit with the first token among those of a condition on ``h``, those of the element
    ``late`` after others; NULL if there is none."""
    order = f"named_struct('start', h.start, 'late', h.element = {sql_string(late)}, 'priority', h.priority, 'rank', h.rank, 'h', h)"
    return f"array_min(transform(filter({source}, h -> {condition}), h -> {order})).h"


def _overlap(a: str, b: str) -> str:
    return f"({a}.start < {b}.start + {b}.size AND {b}.start < {a}.start + {a}.size)"


def resolve(df: DataFrame) -> DataFrame:
    """Add ``spans``: each hit with start and size in tokens, whether it was chosen, and why not."""
    dose = "(_dual1 IS NOT NULL AND (_direct1 IS NULL OR _dual1.start < _direct1.start))"
    df = df.selectExpr("*", f"{_first('true', '_dual')} AS _dual1", f"{_first(_is('methodDirect'))} AS _direct1")
    df = df.selectExpr("*", f"CASE WHEN {dose} THEN _dual1 ELSE _direct1 END AS _verb")
    free = f"(_verb IS NULL OR NOT {_overlap('h', '_verb')})"
    roles = " OR ".join(_is(longer) for shorter, longer in SHORTER_FIRST if shorter == "methodPassive")
    with_direct = f"(_verb IS NOT NULL AND _verb.element = 'methodDirect' AND ({roles}))"
    passive = _is("methodPassive")
    # of readings that begin at the same token the longer ones, with a number, come first
    df = df.selectExpr("*", f"{_first(f'{free} AND ({passive} OR {with_direct})', late='methodPassive')} AS _done")
    start = "array_compact(array(_verb, _done))"
    rest = (
        "array_sort(filter(_hits, h -> h.element NOT IN ('methodDirect', 'methodPassive')), "
        "(a, b) -> CASE WHEN a.priority <> b.priority THEN a.priority - b.priority WHEN a.start <> b.start THEN a.start - b.start "
        "WHEN a.rank <> b.rank THEN a.rank - b.rank ELSE b.size - a.size END)"
    )
    fold = (
        f"aggregate({rest}, {start}, (a, h) -> CASE WHEN exists(a, c -> c.element = h.element OR {_overlap('c', 'h')}) "
        "THEN a ELSE concat(a, array(h)) END)"
    )
    df = df.selectExpr("*", f"{fold} AS _chosen")
    same = "c.element = h.element AND c.start = h.start AND c.size = h.size"
    taken = f"filter(_chosen, c -> {_overlap('c', 'h')})"
    won = f"exists(_chosen, c -> {same} AND (c.pattern = h.pattern OR c.priority < 0))"
    surface = f"translate(regexp_replace(h.hit, {sql_string(r'[^ \x01\x02]*\x02')}, ''), {sql_string(GLUE)}, '')"
    span = (
        "named_struct('element', h.element, 'pattern', h.pattern, 'start', h.start, 'size', h.size, "
        f"'captured', {surface}, 'chosen', {won}, "
        f"'reason', CASE WHEN {won} THEN NULL WHEN size({taken}) > 0 AND {taken}[0].element <> h.element THEN 'overlap' ELSE 'repeat' END, "
        f"'by', CASE WHEN {won} THEN NULL WHEN size({taken}) > 0 THEN {taken}[0].element "
        "ELSE coalesce(filter(_chosen, c -> c.element = h.element)[0].element, _verb.element, _done.element) END)"
    )
    ordered = "array_sort(_hits, (a, b) -> CASE WHEN a.start <> b.start THEN a.start - b.start WHEN a.priority <> b.priority THEN a.priority - b.priority ELSE a.rank - b.rank END)"
    return df.selectExpr("*", f"transform({ordered}, h -> {span}) AS spans")


def _is(key: str) -> str:
    return f"h.element = {sql_string(key)}"


def spans(df: DataFrame, text: str = "dosage_elements") -> DataFrame:
    """Add ``spans``: array of (element, pattern, start, size, captured, chosen, reason, by)."""
    kept = df.columns
    return fence(resolve(candidates(df, text)).select(*kept, "spans"), "spans")


def tags(spans: str = "spans") -> str:
    """SQL: elements of the chosen spans in the order of the text."""
    return f"array_join(transform(filter({spans}, s -> s.chosen), s -> s.element), ' ')"
