"""Text normalisation: raw instruction to the key ``dosage_lower``.

Each step is one column expression.  A fold of many replacements sits behind one
alternation test, so a row without, say, any Latin abbreviation pays for one scan
instead of 25.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.fence import fence

SCREENED = "general_fail: removed"


def dotted(abbreviation: str) -> str:
    """Regex for a Latin abbreviation with or without dots, not inside a word."""
    return r"\b" + r"\.?".join(abbreviation) + r"\.?(?!\w)"


def screen_pattern() -> str:
    """Alternation of all wordings that are too ambiguous to be read."""
    words = vocab.NUMBER_WORDS
    forms = vocab.alternation(w + s for w in vocab.SINGULAR for s in ("", "s"))
    fills = {
        "{word}": "|".join(words),
        "{word2}": "|".join(words[1:]),
        "{adverb}": "|".join(r[2] for r in vocab.PERIOD_UNITS if r[2]),
        "{form}": forms,
    }
    patterns = []
    for pattern in vocab.SCREENED:
        for name, fill in fills.items():
            pattern = pattern.replace(name, fill)
        patterns.append(f"(?:{pattern})")
    return "|".join(patterns)


# step name -> ordered (regex, replacement)
LATIN = [(dotted(word), meaning) for word, meaning in vocab.LATIN]
NUMBER_WORDS = [(rf"\b{w}\b", str(i)) for i, w in enumerate(vocab.NUMBER_WORDS, start=1)]
ISOLATED = [(rf"\b{term}\b", meaning) for term, meaning in vocab.ISOLATED_TERMS]


def replace_terms(text: Column, terms, test: Column | None = None) -> Column:
    """Apply ordered replacements where ``test`` holds, then collapse runs of white space."""
    result = text
    for pattern, replacement in terms:
        result = F.regexp_replace(result, pattern, replacement)
    if test is not None:
        result = F.when(test, result).otherwise(text)
    return F.regexp_replace(result, r"\s{2,}", " ")


def _any_word(words, end: str = r"\b") -> str:
    """One alternation behind one word boundary, so that other places fail at once."""
    return rf"\b(?:{'|'.join(words)}){end}"


def replace_dictionary(
    df: DataFrame,
    column: str,
    terms: dict[str, str | list[str]],
    isolated: bool = True,
    swap: bool = False,
) -> DataFrame:
    """Replace terms in a column by a dictionary.

    ``isolated`` matches whole words only; ``swap`` reads the dictionary the other way
    round, replacement first and the term (or list of terms) second.
    """
    ordered = []
    for left, right in terms.items():
        old, new = (right, left) if swap else (left, right)
        for term in [old] if isinstance(old, str) else list(old):
            ordered.append((rf"\b{term}\b" if isolated else term, new))
    return df.withColumn(column, replace_terms(F.col(column), ordered))


def lower_and_squeeze(text: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(text)), r"[ \t]{2,}|\t", " ")  # a single blank stays as it is


def tidy(text: Column) -> Column:
    """Drop stray dots and blanks at the ends and doubled dots inside."""
    text = F.regexp_replace(F.trim(text), r"\.+$", "")
    text = F.regexp_replace(text, r"^\.\s*", "")
    return F.regexp_replace(text, r"\.\s*\.", ".")


def screen(df: DataFrame, column: str) -> DataFrame:
    """Blank ambiguous rows and give the reason in ``exclude``."""
    hit = F.coalesce(F.col(column).rlike(screen_pattern()), F.lit(False))
    reason = F.when(hit, F.lit(SCREENED))
    df = df.withColumns({"exclude": reason})
    return df.withColumns({column: F.when(F.col("exclude").isNull(), F.col(column)).otherwise(F.lit(""))})


# tests that are true wherever one of the replacements applies
_ANY_LATIN = _any_word((r"\.?".join(word) for word, _ in vocab.LATIN), r"\.?(?!\w)")
_ANY_NUMBER = _any_word(vocab.NUMBER_WORDS)
_ANY_ISOLATED = _any_word(term for term, _ in vocab.ISOLATED_TERMS)

STEPS = {
    "latin": lambda t: replace_terms(t, LATIN, t.rlike(_ANY_LATIN)),
    "words_to_digits": lambda t: replace_terms(t, NUMBER_WORDS, t.rlike(_ANY_NUMBER)),
    "units_of_measure": lambda t: replace_terms(t, vocab.SPOON_SPELLINGS, F.contains(t, F.lit("spoon"))),
    "isolated_terms": lambda t: replace_terms(t, ISOLATED, t.rlike(_ANY_ISOLATED)),
    "date_separators": lambda t: replace_terms(t, vocab.DATE_SEPARATORS),
    "number_ranges": lambda t: replace_terms(t, vocab.NUMBER_RANGES),
}


def normalise(df: DataFrame, text: str = "dosage") -> DataFrame:
    """Add ``dosage_lower`` (normalised text) and ``exclude`` (screening reason)."""
    key = "dosage_lower"
    # one projection per guarded step keeps each step's input a plain column
    df = df.withColumns({key: lower_and_squeeze(F.col(text))})
    df = df.withColumns({key: STEPS["latin"](F.col(key))})
    df = screen(df, key)
    for step in ("words_to_digits", "units_of_measure", "isolated_terms"):
        df = df.withColumns({key: STEPS[step](F.col(key))})
    df = df.withColumns({key: tidy(STEPS["number_ranges"](STEPS["date_separators"](F.col(key))))})
    return fence(df, key, "exclude")
