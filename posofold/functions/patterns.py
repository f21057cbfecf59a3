"""Token patterns: a short notation for regexes over the encoded text.

A pattern is a list of tokens separated by blanks::

    up to frequencyMax=<INT> ~time <PER> period_unit=<PERIOD>

``word`` matches that spelling, ``~word`` any inflection of it, ``a|b`` a choice,
``<CLASS>`` a named class, ``name=...`` captures the token as a field, and a final
``?`` makes the token optional.
"""

from __future__ import annotations

import re

from posofold import vocab
from posofold.functions.stream import SEP, encoded_word

_TAIL = r"(?:\x02[^ \x01]*)?"  # the surface spelling behind a base form
_META = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


def _quote(text: str) -> str:
    return _META.sub(r"\\\1", text).replace("\u0002", r"\x02")


def any_form(words) -> str:
    """Regex for the given base forms in any inflection."""
    return f"(?:{'|'.join(_quote(w) for w in words)}){_TAIL}"


def any_of(words) -> str:
    """Regex for exactly the given spellings."""
    return f"(?:{'|'.join(_quote(encoded_word(w)) for w in words)})"


def periods_without(*left_out: str) -> str:
    return any_form(p for p in vocab.PERIODS if p not in left_out)


_DATE_DAY = r"(?:[0-2]?[1-9]|10|20|30|31)"
_DATE_MONTH = r"(?:0?[0-9]|10|11|12)"
_DATE_YEAR = r"(?:19|20)[0-9]{2}"

CLASSES = {
    "INT": "[0-9]+",
    "DIGIT": "[0-9]",
    "QTY": r"[0-9]+(?:\.5|\.25)?",
    "NUM": rf"(?:[+\-±~]?[.,]*[0-9][0-9.,]*|{'|'.join(vocab.NUMBER_WORDS + vocab.OTHER_NUMBER_WORDS)})",
    "UNIT": any_form(w for w in vocab.SINGULAR if " " not in w),
    "UNITS": f"(?:{any_form(w for w in vocab.SINGULAR if ' ' not in w)}|chewable{SEP}{any_form(['tablet'])})",
    "METRIC": any_of(vocab.METRIC_SPELLINGS),
    "PERIOD": any_form(vocab.PERIODS),
    "PERIOD_TO_MONTH": periods_without("year", "annual"),
    "PERIOD_TO_DAY": periods_without("week", "fortnight", "month", "year", "annual"),
    "PERIOD_TO_WEEK": periods_without("fortnight", "month", "year", "annual"),
    "PERIOD_FROM_HOUR": periods_without("minute"),
    "PER": any_of(vocab.PERIOD_PREFIXES),
    "VERB": any_of(r[0] for r in vocab.METHODS),
    "PHRASE_VERB": "(?:" + "|".join(r[0].replace(" ", SEP) for r in vocab.COMPOUND_METHODS) + ")",
    "DONE": any_of(vocab.PARTICIPLES),
    "SPOON": any_form(["spoon", "spoonful"]),
    "SIZE": r"(?:5|2\.5)",
    "ML": r"[^ \x01]*ml[^ \x01]*",
    "NL": r"\s+",
    "WEEKDAY": any_of([w for r in vocab.WEEKDAYS for w in (r[0], r[0] + "s", r[1])]),
    "HOUR12": "(?:[0-9]|10|11|12)",
    "HALFDAY": "(?:am|pm|noon)",
    "CLOCK": "(?:0[1-9]|1[0-9]|2[0-4]):(?:00|15|30|45)",
    "DMY": rf"{_DATE_DAY}\.{_DATE_MONTH}\.{_DATE_YEAR}",
    "YMD": rf"{_DATE_YEAR}\.{_DATE_MONTH}\.{_DATE_DAY}",
    "FLOW": (
        f"(?:{any_form(['litre', 'litres'])}{SEP}per{SEP}{any_form(['minute'])}"
        f"|microgram(?:s)?{SEP}per{SEP}kilogram(?:s)?{SEP}per{SEP}{any_form(['hour'])}"
        f"|milligram(?:s)?{SEP}per{SEP}{any_form(['minute'])})"
    ),
}


def _token(spec: str) -> str:
    if spec.startswith("<"):
        return CLASSES[spec[1:-1]]
    words = spec.split("|")
    based = [w[1:] for w in words if w.startswith("~")]
    plain = [w for w in words if not w.startswith("~")]
    parts = ([any_form(based)] if based else []) + ([any_of(plain)] if plain else [])
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def compile_pattern(tokens: str, fields: list[str] | None = None) -> str:
    """Regex of a pattern, without the separators around it.

    With ``fields`` given, captured tokens become groups in the order in which their
    names are appended to that list.
    """
    regex, seen_required = "", False
    for spec in tokens.split():
        optional = spec.endswith("?")
        spec = spec[:-1] if optional else spec
        name, found, rest = spec.partition("=")
        if found:
            spec = rest
        body = _token(spec)
        if found and fields is not None:
            fields.append(name)
            body = f"({body})"
        if not seen_required:
            regex += f"(?:{body}{SEP})?" if optional else body
            seen_required = not optional
        else:
            regex += f"(?:{SEP}{body})?" if optional else f"{SEP}{body}"
    return regex


CLASSES["WHEN"] = "(?:" + "|".join(compile_pattern(p) for p in vocab.WHEN_PHRASES) + ")"


def anywhere(bodies) -> str:
    """Regex that finds the first of the given patterns in the encoded text."""
    return rf"(?<={SEP})(?:{'|'.join(bodies)})(?={SEP})"


def needs(tokens: str) -> tuple[str, ...]:
    """Words of which the text must contain one for the pattern to match.

    Used as a cheap test in front of the regex; "0-9" asks for a digit, and an empty
    result means that no such test is known.
    """
    best: tuple[str, ...] = ()
    digit = False
    for spec in tokens.split():
        if spec.endswith("?"):
            continue
        spec = spec.partition("=")[2] or spec
        if spec.startswith("<"):
            digit = digit or spec in ("<INT>", "<QTY>", "<DIGIT>")
            continue
        words = sorted({w.lstrip("~") for w in spec.split("|")}, key=len)
        words = [w for i, w in enumerate(words) if not any(short in w for short in words[:i])]
        if not best or (len(words), -len(words[0])) < (len(best), -len(best[0])):
            best = tuple(words)
    useful = best and all(len(w) > 2 for w in best)
    return best if useful else ("0-9",) if digit else best
