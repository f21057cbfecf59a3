"""Base forms of English words by suffix rules with a table of exceptions.

The token patterns know the inflections of a closed list of nouns.  These rules reduce plurals,
participles and past tenses of any word, as column expressions over a word or an array of words:
the exceptions first, then the first suffix rule that fits, then the repair of what the suffix
left behind (a doubled consonant, a dropped "e").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posofold.functions.text import map_sql

# FIXED VALUES: words whose base form no rule gives.
IRREGULAR = {
    "taken": "take", "took": "take", "given": "give", "gave": "give", "chewed": "chew", "drunk": "drink", "drank": "drink",
    "eaten": "eat", "ate": "eat", "slept": "sleep", "kept": "keep", "felt": "feel", "held": "hold",
    "teeth": "tooth", "feet": "foot", "men": "man", "women": "woman", "children": "child", "lice": "louse",
    "diagnoses": "diagnosis", "axes": "axis", "shown": "show", "known": "know", "worn": "wear", "begun": "begin",
    "broken": "break", "done": "do", "goes": "go", "does": "do", "has": "have", "is": "be", "are": "be", "was": "be", "were": "be",
    "used": "use", "using": "use", "uses": "use", "dies": "die", "dying": "die", "ties": "tie", "lies": "lie", "lying": "lie",
}
# FIXED VALUES: words that only look inflected.
WHOLE = [
    "always", "diabetes", "rabies", "herpes", "scabies", "this", "thus", "plus", "pus", "mucus", "virus", "sinus", "gas", "pancreas",
    "analysis", "diagnosis", "psoriasis", "as", "us", "its", "his", "yes", "less", "unless", "towards", "sometimes", "besides",
    "morning", "evening", "during", "nothing", "something", "anything", "string", "ring", "spring", "wing", "king", "thing", "bring",
    "bed", "red", "need", "feed", "seed", "bleed", "speed", "embed", "hundred", "weed", "med", "dressing",
]


def base_form(word: Column) -> Column:
    """The base form of a word in lower case; other words and NULL stay as they are."""
    known = F.try_element_at(F.expr(map_sql(IRREGULAR | {w: w for w in WHOLE})), word)
    stem_ing, stem_ed = F.regexp_replace(word, "ing$", ""), F.regexp_replace(word, "ed$", "")
    return (
        F.when(known.isNotNull(), known)
        .when(word.rlike("[^aeiou]ies$") & (F.length(word) > 4), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("(?:ss|x|z|ch|sh)es$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike("oes$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike("[a-z]{2,}s$") & ~word.rlike("(?:ss|us|is|'s)$"), F.regexp_replace(word, "s$", ""))
        .when(word.rlike("[aeiouy].*[a-z]ing$"), _repaired(stem_ing))
        .when(word.rlike("[^aeiou]ied$") & (F.length(word) > 4), F.regexp_replace(word, "ied$", "y"))
        .when(word.rlike("[aeiouy].*[a-z]ed$") & ~word.rlike("eed$"), _repaired(stem_ed))
        .otherwise(word)
    )


def _repaired(stem: Column) -> Column:
    """The base form from what is left without "ing" or "ed"."""
    return (
        F.when(stem.rlike(r"([bdgmnprt])\1$"), F.regexp_replace(stem, r"(.)\1$", "$1"))
        # consonants that end no word without an "e", and vowel + single consonant after a consonant cluster or alone
        .when(stem.rlike("(?:[cgsuvz]|[bcdfgkptz]l|[^aeiou][aeiou]k|[aeiou]qu|[aiu]t|[^aeo]ir|[ou]r|bas|[^f]in|hal|rib)$") & ~_closed(stem), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def _closed(stem: Column) -> Column:
    """Stems that are words as they are, although their ending often lacks an "e"."""
    return stem.rlike("(?:ss|ng|ou|eat|oat|ait|wait|treat|repeat|visit|limit|inhibit|edit|vomit|deposit|profit|unit|habit|pour|our|eer|bour|mix|gas|focus|rain|stain|contain|obtain|drain|train|pain|gain|main|begin|join|spoon|rub)$")


def base_forms(words: Column) -> Column:
    """The base forms of an array of words."""
    return F.transform(words, base_form)
