"""Tokens as one encoded string, so that token patterns are plain regexes.

Layout: tokens are separated by one separator, a space where the text had one and
``GLUE`` where two tokens touched ("5mg" is two tokens).  An inflected word is
written ``base NORM surface``, so a pattern may ask for either form.  Decoding drops
the base forms and the glue and gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posofold import vocab

GLUE, NORM = "\u0001", "\u0002"
SEP = r"[ \x01]"
_IN = r"[^\s\x01]"  # a character inside a token

_MARK = r"(?![a-z0-9 \x01])"  # fails fast on ordinary characters
_OPENING = r"""[(){}\[\]<>_#*&,:;!?¿¡…"'“”‘’`´«»§%=—–$£€]"""
_CLOSING = r"""[(){}\[\]<>_#*&,:;!?¿¡…"'“”‘’`´«»—–.]"""

# nouns of timing phrases that take a plural "s"
_TIMING_NOUNS = [
    "meal", "breakfast", "lunchtime", "dinner", "food", "morning", "afternoon", "evening",
    "night", "bedtime", "bowel", "movement", "stomach", "procedure", "noon",
]
_ES = ["patch", "lunch"]
_IES = ["pessar", "suppositor"]
_S = [w for w in vocab.PAREN_S if w not in _ES] + _TIMING_NOUNS


def surface_forms() -> dict[str, str]:
    """Inflected word -> its base form."""
    forms = {w + "s": w for w in _S}
    forms.update({w + "es": w for w in _ES})
    forms.update({w + "ies": w + "y" for w in _IES})
    forms.update({w + "(s)": w for w in vocab.PAREN_S})
    return forms


_BASE = surface_forms()


def encoded_word(surface: str) -> str:
    """How a given spelling appears in the encoded text."""
    return f"{_BASE[surface]}{NORM}{surface}" if surface in _BASE else surface


def encode(text: Column) -> Column:
    """Text to encoded tokens."""
    steps = [
        # control characters in the source must not look like ours
        (r"[\x01\x02]", "�"),
        # white space other than a blank is a token of its own
        (r"([^\S ]+)", f"{GLUE}$1{GLUE}"),
        # opening and closing punctuation; "word(s)" keeps its bracket
        (rf"{_MARK}(?<!{_IN})({_OPENING}+)(?={_IN})", f"$1{GLUE}"),
        (rf"{_MARK}(?<={_IN})(?<!\(s)({_CLOSING}+)(?!{_IN})", f"{GLUE}$1"),
        # inside a word: slash, dash, other joints, digit next to letter
        (r"(?<=[^\s\x01/\-])([/\-])", f"{GLUE}$1{GLUE}"),
        (
            rf"{_MARK}((?<=[a-z]),(?=[a-z])|(?<=[a-z0-9])[:<>=](?=[a-z])|\.\.+|…"
            r"|(?<=[0-9])[+*^](?=[0-9])|(?<=[a-z])[–—~](?=[a-z]))",
            f"{GLUE}$1{GLUE}",
        ),
        (r"(?<=[0-9])(?=[a-zA-Z])", GLUE),
        # no glue next to a blank, no doubled glue
        (r"\x01+(?= )|(?<= )\x01+|^\x01+|\x01+$", ""),
        (r"\x01\x01+", GLUE),
    ]
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    text = F.concat(F.lit(" "), text, F.lit(" "))
    ends_in_s = rf"(?<={SEP})(?=[a-z]+(?:s|\(s\)){SEP})"
    inflections = [
        (rf"{ends_in_s}({'|'.join(_S)})(s|\(s\))(?={SEP})", f"$1{NORM}$1$2"),
        (rf"{ends_in_s}({'|'.join(_ES)})(es|\(s\))(?={SEP})", f"$1{NORM}$1$2"),
        (rf"{ends_in_s}({'|'.join(_IES)})ies(?={SEP})", f"$1y{NORM}$1ies"),
    ]
    for pattern, replacement in inflections:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def decode(tokens: Column) -> Column:
    """Encoded tokens back to text."""
    return F.translate(F.regexp_replace(tokens, r"[^ \x01\x02]*\x02", ""), GLUE, "")


def tokens_of(tokens: Column) -> Column:
    """Encoded text to the array of surface tokens."""
    return F.filter(
        F.split(F.regexp_replace(tokens, r"[^ \x01\x02]*\x02", ""), SEP), lambda t: t != ""
    )


def norms_of(tokens: Column) -> Column:
    """Encoded text to the array of base forms."""
    return F.filter(F.split(F.regexp_replace(tokens, r"\x02[^ \x01]*", ""), SEP), lambda t: t != "")
