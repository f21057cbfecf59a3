"""Codes for units, methods, routes, timings and other terms, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.text import filled, first_hit_in, lookup, lookup_struct

SNOMED, UCUM = "http://snomed.info/sct", "http://unitsofmeasure.org"

_UNIT = ("display", "system", "code")
_CODE = ("code", "display")

_units: dict[str, tuple] = {w: (ucum, UCUM, ucum) for w, ucum in vocab.METRIC_UCUM.items()}
for _one, _many, _code, _display, _ in vocab.DOSE_FORMS:
    if _code:
        _units.update({w: (_display, SNOMED, _code) for w in (_one, _many, f"{_one}(s)")})
_spoons = {
    size: (display, SNOMED if code else None, code) for size, code, display in vocab.SPOON_SIZES
}
_methods = {r[0]: (r[2], r[3]) for r in vocab.METHODS if r[2]}
_methods.update({base: _methods[verb] for verb, done, code, _ in vocab.METHODS if code
                 for base in [vocab.PARTICIPLES[done]]})
_methods.update({phrase: (code, display) for phrase, code, display in vocab.COMPOUND_METHODS})
_routes = {r[0]: (r[1], r[2]) for r in vocab.ROUTES if r[1]}
_extras = {phrase: (code, display) for phrase, code, display in vocab.EXTRAS_CODES}
_instructions = {phrase: (code, display) for phrase, code, display in vocab.WHEN_AS_INSTRUCTION}


def _key(text: Column) -> Column:
    return F.lower(F.trim(text))


def unit(text: Column, spoonsize: Column | None = None) -> Column:
    """(display, system, code): a spoon by its size, a dose form in SNOMED, a metric unit
    in UCUM, anything else as it is."""
    key = _key(text)
    as_is = F.struct(text.alias("display"), F.lit(UCUM).alias("system"), text.alias("code"))
    coded = F.coalesce(lookup_struct(_units, _UNIT, key), as_is)
    if spoonsize is not None:
        spoon = F.when(
            key.isin("spoon", "spoons", "spoonful", "spoonfuls"), lookup_struct(_spoons, _UNIT, F.trim(spoonsize))
        )
        coded = F.coalesce(spoon, coded)
    return F.when(filled(text), coded)


def method(verb: Column) -> Column:
    """(code, display) of a method verb or phrase."""
    return lookup_struct(_methods, _CODE, _key(verb))


def route(name: Column) -> Column:
    """(code, display) of a route by its exact name."""
    return lookup_struct(_routes, _CODE, _key(name))


def extra(text: Column) -> Column:
    """(code, display) of an additional instruction."""
    return lookup_struct(_extras, _CODE, _key(text))


def instruction(phrase: Column) -> Column:
    """(code, display) of a timing phrase that is an instruction."""
    return lookup_struct(_instructions, _CODE, phrase)


def site(column: str) -> Column:
    """(code, display, description) of the first site keyword in the text."""
    hits = [(r[0], r[1:]) for r in vocab.SITES]
    return first_hit_in(column, hits, ("code", "display", "description"))


def indication(column: str) -> Column:
    """(code, display) of the longest indication keyword in the text."""
    table = sorted(vocab.INDICATIONS, key=lambda r: len(r[0]), reverse=True)
    return first_hit_in(column, [(r[0], r[1:]) for r in table], _CODE)


def period_ucum(text: Column) -> Column:
    return lookup(vocab.PERIOD_UCUM, _key(text))


def weekdays(text: Column) -> Column:
    """FHIR day codes of the weekdays named in the text, NULL when there are none."""
    names = {name for day, code in vocab.WEEKDAYS for name in (day, code)}
    words = F.filter(F.split(F.lower(text), r"[,\s]+"), lambda w: w.isin(*sorted(names)))
    return F.when(F.size(words) > 0, F.transform(words, lambda w: F.substring(w, 1, 3)))


_TIMES = [*vocab.WHEN_PHRASE_CODES, *((w, code) for w, _, code in vocab.WHEN_WORDS if code)]
_WHEN = ("kind", "value")


def when(column: str) -> Column:
    """(kind, value) of a timing text.

    A text is a coded instruction ("before food"), an instruction in plain text or a
    FHIR timing code; the first keyword that it contains decides.
    """
    hits = [(k, ("instruction", k)) for k in _instructions]
    hits += [(k, ("text", None)) for k in vocab.WHEN_AS_TEXT]
    hits += [(k, ("timing", code)) for k, code in _TIMES]
    plain = F.when(filled(F.col(column)), F.expr("named_struct('kind', 'text', 'value', CAST(NULL AS STRING))"))
    return F.coalesce(first_hit_in(column, hits, _WHEN), plain)
