"""The ten elements that are read by regex from the already tagged text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions import phrases
from posofold.functions.fence import fence
from posofold.functions.text import first_hit_in, first_match, lookup, replace_first

_ADVERB_TO_ROUTE = {adverb: route for route, _, _, adverb in vocab.ROUTES if adverb}

# element -> its phrases, in the order in which they are read
PHRASES: dict[str, list[str]] = {
    "extrasAsDirected": vocab.AS_DIRECTED,
    "extras": vocab.EXTRAS,
    "extrasPAUSE": vocab.EXTRAS_PAUSE,
    "extrasALTER": vocab.EXTRAS_ALTER,
    "asNeededCodeableConcept": [phrases.indication()],
    "asNeededBoolean": vocab.AS_NEEDED,
    "forElement": [phrases.indication()],
    "route": [r[0] for r in vocab.ROUTES] + list(_ADVERB_TO_ROUTE),
    "site": [phrases.site()],
}
LEADING = {"extras_b": vocab.EXTRAS_NUMERIC}

_OTHER_AS_NEEDED = "|".join(re.escape(p) for p in vocab.AS_NEEDED if p != vocab.AS_NEEDED_CANONICAL)
_ANY_AS_NEEDED = "|".join(re.escape(p) for p in vocab.AS_NEEDED)


def element_pattern(element: str, words: list[str]) -> str:
    """Alternation that tries the longest pattern text first."""
    pattern = "|".join(vocab.longest_first(words))
    if element == "asNeededCodeableConcept":
        # any as-needed wording followed by any indication
        return f"(?:{_ANY_AS_NEEDED}) (?:{pattern})"
    return pattern


_NEED = ("need", "requir", "necess")
_NEEDS = (*_NEED, *(p for p in vocab.AS_NEEDED if not any(n in p for n in _NEED)))

# A cheap test that is true whenever the pattern can match, where one is worth having.
_HINT = {
    "asNeededCodeableConcept": _NEEDS,
    "asNeededBoolean": _NEEDS,
    "forElement": ("for ", "to "),
    "extrasAsDirected": ("as directed",),
    "extrasALTER": ("drowsiness",),
    "site": ("eye", "nostril", "area", "nail", "tongue", "rectum"),
}


def _read(df: DataFrame, element: str, words: list[str], text: str, out: str) -> DataFrame:
    pattern = element_pattern(element, words)
    found = first_match(F.col(text), pattern)
    hints = _HINT.get(element)
    if hints:
        test = F.col(text).contains(hints[0])
        for hint in hints[1:]:
            test = test | F.col(text).contains(hint)
        found = F.when(test, found).when(F.col(text).isNotNull(), F.lit(""))
    tagged = F.when(found == "", F.col(text)).otherwise(replace_first(F.col(text), pattern, f"*{element}*"))
    return df.select("*", found.alias(f"_raw_{element}"), tagged.alias(out))


def _chain(df: DataFrame, groups: dict[str, list[str]], text: str) -> tuple[DataFrame, str]:
    for element, words in groups.items():
        out = f"_text_{element}"
        df = _read(df, element, words, text, out)
        text = out
    return df, text


def read_leading(df: DataFrame, text: str = "dosage_elements") -> DataFrame:
    """Read the phrases with numbers of their own before any number pattern does."""
    df, state = _chain(df, LEADING, text)
    df = df.withColumns({"extras_b_clean": F.col("_raw_extras_b"), text: F.col(state)})
    return df.drop("_raw_extras_b", state)


def _as_directed(raw: Column) -> Column:
    """Generic forms become "as directed"; "by <professional>" keeps its wording."""
    return F.when(raw.rlike(r"\bby\b"), raw).when(raw != "", F.lit("as directed")).otherwise(raw)


def _indication(raw: Column) -> Column:
    """Drop the as-needed wording and keep the indication."""
    canonical = F.regexp_replace(raw, rf"(?i)\b(?:{_OTHER_AS_NEEDED})\b", vocab.AS_NEEDED_CANONICAL)
    return F.regexp_replace(canonical, rf"(?i)^(?:{_ANY_AS_NEEDED}) ", "")


def _site(raw: str) -> Column:
    """Display name of the longest site keyword in the text, else the text."""
    hits = sorted(((r[0], r[3]) for r in vocab.SITES), key=lambda h: len(h[0]), reverse=True)
    return F.coalesce(first_hit_in(raw, hits), F.col(raw))


def read_phrases(df: DataFrame, text: str = "dosage_elements") -> DataFrame:
    """Read and tag the regex elements: ``<element>_clean`` is '' where absent."""
    df, state = _chain(df, PHRASES, text)
    raw = {e: F.col(f"_raw_{e}") for e in PHRASES}
    clean = dict(raw)
    clean["extrasAsDirected"] = _as_directed(raw["extrasAsDirected"])
    clean["asNeededCodeableConcept"] = _indication(raw["asNeededCodeableConcept"])
    clean["asNeededBoolean"] = F.when(raw["asNeededBoolean"] != "", F.lit(vocab.AS_NEEDED_CANONICAL)).otherwise(
        raw["asNeededBoolean"]
    )
    clean["route"] = F.coalesce(lookup(_ADVERB_TO_ROUTE, raw["route"]), raw["route"])
    clean["site"] = _site("_raw_site")
    new = {f"{e}_clean": c for e, c in clean.items()}
    df = df.withColumns({**new, "route_adverbial": raw["route"], text: F.col(state)})
    df = df.drop(*[f"_raw_{e}" for e in PHRASES], *[f"_text_{e}" for e in PHRASES])
    return fence(df, *new, "route_adverbial", text)
