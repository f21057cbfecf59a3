"""The vocabulary as small dimension tables (fixed size, a few hundred rows)."""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.text import map_sql
from posofold.operators.elements import ELEMENTS
from posofold.operators.normalise import ISOLATED, LATIN, NUMBER_WORDS
from posofold.sources.tables import read

MAX_CHANGED = 200  # more changed terms than this and all texts are assessed anew
MAX_SITE = 1000  # words of a site's own vocabulary


def term_rows() -> list[tuple[str, str, str | None]]:
    """(list, term, meaning or code) of every plain word or phrase."""
    rows: list[tuple[str, str, str | None]] = []
    for singular, plural, code, _, _ in vocab.DOSE_FORMS:
        rows += [("dose_form", singular, code), ("dose_form", plural, code)]
    rows += [("period_unit", w, ucum) for w, ucum in vocab.PERIOD_UCUM.items()]
    rows += [("metric_unit", w, ucum) for w, ucum in vocab.METRIC_UCUM.items()]
    rows += [("method", verb, code) for verb, _, code, _ in vocab.METHODS]
    rows += [("participle", done, verb) for done, verb in vocab.PARTICIPLES.items()]
    rows += [("method", phrase, code) for phrase, code, _ in vocab.COMPOUND_METHODS]
    rows += [("route", name, code) for name, code, _, _ in vocab.ROUTES]
    rows += [("route", adverb, name) for name, _, _, adverb in vocab.ROUTES if adverb]
    rows += [("site", name, code) for name, code, _, _ in vocab.SITES]
    rows += [("weekday", day, code) for day, code in vocab.WEEKDAYS]
    rows += [("when", term, how) for term, how, _ in vocab.WHEN_WORDS]
    rows += [("indication", term, code) for term, code, _ in vocab.INDICATIONS]
    rows += [("as_needed", term, None) for term in vocab.AS_NEEDED]
    rows += [("extra", term, code) for term, code, _ in vocab.EXTRAS_CODES]
    rows += [("number_word", term, str(i)) for i, term in enumerate(vocab.NUMBER_WORDS, start=1)]
    rows += [("latin", term, meaning) for term, meaning in vocab.LATIN]
    return rows


def terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(term_rows(), "list string, term string, meaning string")


def patterns(spark: SparkSession) -> DataFrame:
    """(element, pattern, tokens, wording) of every token pattern."""
    rows = [(e.key, p.name, p.tokens, p.wording) for e in ELEMENTS for p in e.patterns]
    return spark.createDataFrame(rows, "element string, pattern string, tokens string, wording string")


def normalisation_rules() -> list[tuple[str, str, str, str]]:
    """(step, rule, replacement, regex) as used by the rule report."""
    rows = [
        ("latin_dotted", term, meaning, rf"\b{regex}\b")
        for (term, meaning), (regex, _) in zip(vocab.LATIN, LATIN, strict=True)
    ]
    rows += [("latin", term, meaning, rf"\b{term}\b") for term, meaning in vocab.LATIN]
    rows += [
        ("words_to_digits", term, digit, regex)
        for term, (regex, digit) in zip(vocab.NUMBER_WORDS, NUMBER_WORDS, strict=True)
    ]
    rows += [("units_of_measure", term, to, term) for term, to in vocab.SPOON_SPELLINGS]
    rows += [
        ("isolated_terms", term, to, regex)
        for (term, to), (regex, _) in zip(vocab.ISOLATED_TERMS, ISOLATED, strict=True)
    ]
    rows += [("normalise_date_separators", term, to, term) for term, to in vocab.DATE_SEPARATORS]
    rows += [("normalise_number_ranges", term, to, term) for term, to in vocab.NUMBER_RANGES]
    return rows


# list -> the columns of its rows that are words or phrases of a text
_TERM_COLUMNS = {
    "DOSE_FORMS": (0, 1), "PERIOD_UNITS": (0, 1, 2), "METRIC_UNITS": (0, 4), "METHODS": (0, 1),
    "COMPOUND_METHODS": (0,), "ROUTES": (0, 3), "SITES": (0,), "WEEKDAYS": (0, 1), "WHEN_WORDS": (0,),
    "INDICATIONS": (0,), "EXTRAS_CODES": (0,),
}
_WORD_LISTS = ("AS_NEEDED",)
# lists that only normalisation reads, which every run does anew
_NORMALISED = ("LATIN", "NUMBER_WORDS", "ISOLATED_TERMS", "SPOON_SPELLINGS", "DATE_SEPARATORS", "NUMBER_RANGES")
# tables that are made from the lists above
_DERIVED = (
    "SINGULAR", "PLURAL", "UNIT_DOSE", "PERIODS", "PERIOD_UCUM", "PERIOD_DAYS", "METRIC_SPELLINGS", "METRIC_UCUM",
    "METRIC_FACTOR", "MASS", "VOLUME", "PARTICIPLES", "PAREN_S",
)
RULES = "rules"


def assessed_with() -> set[tuple[str, str, str]]:
    """(list, term, entry) of everything that an assessment depends on: each term with its whole
    entry, and one fingerprint of all that is no term (rules, limits, phrases, code)."""
    rows = set()
    for name, columns in _TERM_COLUMNS.items():
        for row in getattr(vocab, name):
            entry = "|".join("-" if c is None else c for c in row)
            for column in columns:
                words = (row[column] or "").split() if (name, column) == ("METRIC_UNITS", 4) else [row[column]]
                rows |= {(name, term, entry) for term in words if term}
    rows |= {(name, term, term) for name in _WORD_LISTS for term in getattr(vocab, name)}
    digest = hashlib.sha256()
    known = {*_TERM_COLUMNS, *_WORD_LISTS, *_NORMALISED, *_DERIVED}
    for name in sorted(n for n in vars(vocab) if n.isupper() and n.strip("_") not in known):
        digest.update(f"{name}={getattr(vocab, name)!r};".encode())
    package = Path(vocab.__file__).parent
    for file in sorted([*package.glob("operators/*.py"), *package.glob("functions/*.py")]):
        digest.update(file.read_bytes())
    return rows | {(RULES, "", digest.hexdigest())}


def changed_terms(before: set[tuple[str, str, str]], now: set[tuple[str, str, str]]) -> list[str] | None:
    """Terms whose entry was added, altered or dropped; None if more than terms has changed."""
    changed = before ^ now
    if any(name == RULES for name, _, _ in changed) or len({term for _, term, _ in changed}) > MAX_CHANGED:
        return None
    return sorted({term for _, term, _ in changed})


def holds(text: str, terms_: list[str]) -> Column:
    """Whether a text holds any of the terms, be it within a longer word."""
    low = F.col(text)
    return reduce(or_, [F.contains(low, F.lit(t.lower())) for t in terms_], F.lit(False))


def replace_words(text: Column, meanings: dict[str, str]) -> Column:
    """Single words, in any case, by their meaning; all else as it was."""
    if not meanings:
        return text
    table = F.expr(map_sql({k.lower(): v for k, v in meanings.items()}))
    words = F.transform(F.split(text, r"\b"), lambda w: F.coalesce(F.try_element_at(table, F.lower(w)), w))
    return F.array_join(words, "")


def site_terms(spark: SparkSession, name: str | None) -> dict[str, str]:
    """The site's own words (term, meaning) of a dataset: single words, ``MAX_SITE`` at most."""
    if not name:
        return {}
    rows = read(spark, name).select("term", "meaning").where("term is not null and meaning is not null")
    found = {r["term"].lower(): r["meaning"] for r in rows.distinct().orderBy("term", "meaning").limit(MAX_SITE + 1).collect()}
    if len(found) > MAX_SITE or any(not re.fullmatch(r"\w+", t) for t in found):
        raise ValueError(f"the site's vocabulary is single words, {MAX_SITE} at most")
    return found
