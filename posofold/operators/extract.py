"""Token-pattern extraction (elements, overlap rules, tagging) as column expressions.

Every element claims its leftmost, longest match among the tokens that are still free
and leaves the marker ``*element*`` in their place.  A marker matches no pattern, so
two elements never share a token.  The whole operator is a chain of projections:
nothing is shuffled and no row leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.fence import fence
from posofold.functions.patterns import anywhere, compile_pattern, needs
from posofold.functions.stream import GLUE, SEP, decode, encode
from posofold.functions.text import map_sql, sql_string
from posofold.operators.elements import BY_KEY, ELEMENTS, Element, Pattern, element_columns

# The steps are generated from the element declarations, so they are written as SQL
# expressions: one call per step instead of one per expression node.


def _whole(hit: str, body: str) -> str:
    return f"{hit} RLIKE {sql_string(f'^(?:{body})$')}"


def _find(state: str, body: str) -> str:
    """First match in the free tokens, or an empty string."""
    return f"regexp_extract({state}, {sql_string(anywhere([body]))}, 0)"


def _find_element(state: str, element: Element) -> str:
    """The same behind a cheap test for a word that every match contains."""
    found = _find(state, element.any_match)
    words = [needs(p.tokens) for p in element.patterns]
    if not all(words):
        return found
    tests = dict.fromkeys(w for group in words for w in group)
    test = " OR ".join(
        f"{state} RLIKE '[0-9]'" if w == "0-9" else f"contains({state}, {sql_string(w)})" for w in tests
    )
    return f"CASE WHEN {test} THEN {found} ELSE '' END"


def _claim(state: str, body: str, marker: str) -> str:
    """The text with the marker in place of the first match."""
    prefix = sql_string(rf"(?s)^(.*?{SEP})(?:{body})(?={SEP})")
    return f"regexp_replace({state}, {prefix}, '$1*{marker}*')"


_DASHED = sql_string(rf"^\d+{SEP}?-{SEP}?\d+")


def _claim_element(state: str, hit: str, element: Element) -> str:
    body = element.any_match
    dashed = ""
    if element.dashable:
        dashed = f"WHEN {hit} RLIKE {_DASHED} THEN {_claim(state, body, element.key + 'Dashed')} "
    return f"CASE WHEN {hit} = '' THEN {state} {dashed}ELSE {_claim(state, body, element.key)} END"


def _step(df: DataFrame, element: Element, state: str, early: bool) -> DataFrame:
    """One element claims its tokens; ``early`` hits were claimed by a method rule."""
    found = _find_element(state, element)
    if early:
        found = f"CASE WHEN _early_{element.key} = '' THEN {found} ELSE '' END"
    hit = f"concat({found}, _early_{element.key})" if early else found
    return df.selectExpr(
        "*",
        f"{hit} AS _hit_{element.key}",
        f"{_claim_element(state, found, element)} AS _after_{element.key}",
    )


def _methods(df: DataFrame, state: str) -> DataFrame:
    """methodDirect and methodPassive with their two special readings.

    A word such as "spray" behind a quantity is the unit of a dose, not a method.  When
    both a direct and a passive method occur, "to be taken 3 times a day" is read as
    one frequency (or timing) and not as a passive method.
    """
    direct, passive = BY_KEY["methodDirect"].any_match, BY_KEY["methodPassive"].any_match
    frequency, when = BY_KEY["frequencyWithMethod"].any_match, BY_KEY["whenWithMethod"].any_match
    dual = compile_pattern(f"<QTY> {'|'.join(vocab.VERB_OR_UNIT)}")
    is_dose = _whole("_verb", dual)
    df = df.selectExpr("*", f"{_find(state, f'{dual}|{direct}')} AS _verb")
    df = df.selectExpr(
        "*",
        f"CASE WHEN {is_dose} THEN '' ELSE _verb END AS _hit_methodDirect",
        f"CASE WHEN {is_dose} THEN _verb ELSE '' END AS _early_doseQuantity",
        f"CASE WHEN _verb = '' THEN {state} WHEN {is_dose} THEN {_claim(state, dual, 'doseQuantity')} "
        f"ELSE {_claim(state, direct, 'methodDirect')} END AS _after_methodDirect",
    )
    state = "_after_methodDirect"
    longer = f"{frequency}|{when}|{passive}"
    df = df.selectExpr(
        "*",
        f"CASE WHEN _hit_methodDirect = '' THEN {_find(state, passive)} "
        f"ELSE {_find(state, longer)} END AS _done",
    )
    df = df.selectExpr(
        "*",
        f"CASE WHEN _done = '' THEN '' WHEN {_whole('_done', passive)} THEN 'methodPassive' "
        f"WHEN {_whole('_done', frequency)} THEN 'frequencyWithMethod' ELSE 'whenWithMethod' END AS _role",
    )
    return df.selectExpr(
        "*",
        "CASE WHEN _role = 'methodPassive' THEN _done ELSE '' END AS _hit_methodPassive",
        "CASE WHEN _role = 'frequencyWithMethod' THEN _done ELSE '' END AS _early_frequencyWithMethod",
        "CASE WHEN _role = 'whenWithMethod' THEN _done ELSE '' END AS _early_whenWithMethod",
        f"CASE _role WHEN '' THEN {state} "
        f"WHEN 'methodPassive' THEN {_claim(state, passive, 'methodPassive')} "
        f"WHEN 'frequencyWithMethod' THEN {_claim(state, longer, 'frequencyWithMethod')} "
        f"ELSE {_claim(state, longer, 'whenWithMethod')} END AS _after_methodPassive",
    )


def claim_elements(
    df: DataFrame, text: str, only: tuple[str, ...] | None = None, until: tuple[str, ...] | None = None
) -> tuple[DataFrame, str]:
    """Add ``_hit_<element>`` (encoded match or ''); returns also the tagged column.

    ``only`` leaves out elements (and the rules between methods and others); ``until`` names
    the elements to claim before stopping.
    """
    df = df.select("*", encode(F.col(text)).alias("_tokens"))
    state, early = "_tokens", set()
    chosen = [e for e in ELEMENTS if only is None or e.key in only]
    if only is None:
        df = _methods(df, state)
        state = "_after_methodPassive"
        early = {"doseQuantity", "frequencyWithMethod", "whenWithMethod"}
        chosen = [e for e in chosen if e.key not in ("methodDirect", "methodPassive")]
    if until is not None:
        chosen = [e for e in chosen if e.key in until]
    for element in chosen:
        df = _step(df, element, state, element.key in early)
        state = f"_after_{element.key}"
    return df, state


# ------------------------------------------------------------------ fields


_BASE_FORM = sql_string(r"[^ \x01\x02]*\x02")
_GLUE = sql_string(GLUE)


def _surface(tokens: str) -> str:
    return f"translate(regexp_replace({tokens}, {_BASE_FORM}, ''), {_GLUE}, '')"


def _pattern_name(element: Element) -> str:
    hit = f"_hit_{element.key}"
    *first, last = element.patterns
    tests = " ".join(f"WHEN {_whole(hit, p.plain)} THEN '{p.name}'" for p in first)
    return f"CASE WHEN coalesce({hit}, '') = '' THEN NULL {tests} ELSE '{last.name}' END"


def _field(element: Element, name: str) -> str:
    """Value of a field: NULL without the element, '' without the field."""
    hit, pattern = f"_hit_{element.key}", f"{element.key}_pattern"
    cases = []
    for p in element.patterns:
        if p.fixed.get(name) == "@span":
            value = _surface(hit)
        elif name in p.fixed:
            value = sql_string(p.fixed[name])
        elif name in p.groups:
            group = p.groups.index(name) + 1
            value = _surface(f"regexp_extract({hit}, {sql_string(f'^{p.regex}$')}, {group})")
        else:
            continue
        cases.append(f"WHEN {pattern} = '{p.name}' THEN {value}")
    value = f"CASE WHEN {pattern} IS NULL THEN NULL {' '.join(cases)} ELSE '' END"
    if name == "verb" and element.key == "methodPassive":
        value = f"try_element_at({map_sql(vocab.PARTICIPLES)}, {value})"
    return value


def _paren_units(unit: str, quantity: str) -> str:
    """ "tablet(s)" becomes singular or plural by its quantity; no number means one."""
    base = f"replace({unit}, '(s)', '')"
    return (
        f"CASE WHEN NOT endswith({unit}, '(s)') THEN {unit} "
        f"WHEN coalesce(try_cast({quantity} AS DOUBLE), 1D) = 1D THEN {base} "
        f"ELSE coalesce(try_element_at({map_sql(vocab.PAREN_S)}, {base}), concat({base}, 's')) END"
    )


def _wording(element: Element, p: Pattern) -> str:
    if p.wording == "@span":
        return f"{element.key}_captured"
    parts = [part for part in re.split(r"(\{\w+\})", p.wording) if part]
    texts = [
        f"{element.key}_{part[1:-1]}" if part.startswith("{") else sql_string(part) for part in parts
    ]
    return f"concat({', '.join(texts)})"


def read_fields(df: DataFrame, elements=ELEMENTS) -> DataFrame:
    """Turn the claimed tokens into pattern, captured text, fields and clean wording."""
    df = df.selectExpr("*", *[f"{_pattern_name(e)} AS {e.key}_pattern" for e in elements])
    columns = []
    for e in elements:
        hit = f"_hit_{e.key}"
        columns.append(f"CASE WHEN {e.key}_pattern IS NOT NULL THEN {_surface(hit)} END AS {e.key}_captured")
        for f in e.fields:
            name = f"{e.key}__{f}" if f in e.plural_by else f"{e.key}_{f}"
            columns.append(f"{_field(e, f)} AS {name}")
    df = df.selectExpr("*", *columns)
    units = [
        f"{_paren_units(f'{e.key}__{unit}', f'{e.key}_{quantity}')} AS {e.key}_{unit}"
        for e in elements
        for unit, quantity in e.plural_by.items()
    ]
    if units:
        df = df.selectExpr("*", *units)
    cleans = []
    for e in elements:
        cases = " ".join(f"WHEN '{p.name}' THEN {_wording(e, p)}" for p in e.patterns)
        cleans.append(f"CASE {e.key}_pattern {cases} END AS {e.key}_clean")
    return df.selectExpr("*", *cleans)


def extract_element(df: DataFrame, key: str, text: str = "dosage_elements") -> DataFrame:
    """The columns of one element, as ``extract_elements`` would find it.

    Elements before it claim their tokens, but neither their fields nor later elements are
    computed, and ``text`` stays as it is.
    """
    order = [e.key for e in ELEMENTS]
    before = tuple(order[: max(order.index(key), order.index("methodPassive")) + 1])
    kept = df.columns
    df, _ = claim_elements(df, text, None, before)
    df = read_fields(df.select(*kept, f"_hit_{key}"), (BY_KEY[key],))
    new = [f"{key}_pattern", *element_columns(BY_KEY[key])]
    return fence(df.select(*kept, *new), *new)


def extract_elements(
    df: DataFrame, text: str = "dosage_elements", only: tuple[str, ...] | None = None
) -> DataFrame:
    """Extract the token-pattern elements from ``text`` and tag it.

    Adds ``<element>_clean``, ``_captured``, ``_pattern`` and one column per field: NULL
    where the element is absent, an empty string where it is present without that field.
    ``text`` itself is replaced by the tagged text.
    """
    elements = tuple(e for e in ELEMENTS if only is None or e.key in only)
    df, state = claim_elements(df, text, only)
    df = read_fields(df, elements)
    tagged = F.trim(F.regexp_replace(decode(F.col(state)), r"\s+", " "))
    df = df.withColumns({text: tagged})
    scratch = ["_tokens", "_verb", "_done", "_role"]
    scratch += [f"_{kind}_{e.key}" for e in elements for kind in ("hit", "after", "early")]
    scratch += [f"{e.key}__{unit}" for e in elements for unit in e.plural_by]
    new = [c for e in elements for c in (f"{e.key}_pattern", *element_columns(e))]
    return fence(df.drop(*scratch), text, *new)
