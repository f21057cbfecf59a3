"""Regexes of purpose and site phrases, put together from the vocabulary."""

from __future__ import annotations

import re

from posofold import vocab

_YOUR = "(?:your )?"
_HELP_DO = "(?:to(?: help)?|for(?: help(?:ing)?)?)"
_HELP_DOING = "(?:to help|for)"


def any_of(words: list[str]) -> str:
    """One of the words; longer ones are tried first, "(s)" allows a plural."""
    return "(?:" + "|".join(re.escape(w.removesuffix("(s)")) + "s?" * w.endswith("(s)") for w in _longest(words)) + ")"


def _longest(words: list[str]) -> list[str]:
    return sorted(words, key=lambda w: len(w.replace("(s)", "s")), reverse=True)


def _phrase(text: str) -> str:
    return re.escape(text).replace(re.escape("(s)"), "s?")


def ing(verb: str) -> str:
    if verb.endswith("e"):
        return verb[:-1] + "ing"
    return verb + ("ling" if verb.endswith("ol") else "ing")


def _aim(kind: str, before: str, what: str, helped: bool = True) -> str:
    """"to reduce" or "for reducing" something; with help also "for helping reduce" and the like."""
    verbs = [verb for verb, kinds in vocab.PURPOSE_VERBS if kind in kinds.split()]
    do, doing = any_of(verbs), any_of([ing(v) for v in verbs])
    leads = (_HELP_DO, _HELP_DOING) if helped else ("to", "for")
    return f"(?:{leads[0]} {do}|{leads[1]} {doing}) {before}{what}"


def _pains() -> str:
    body, degrees = any_of(vocab.PURPOSES["body"]), any_of(vocab.PAIN_DEGREES)
    return f"(?:(?:{degrees} )?{body} pain|{any_of(vocab.PURPOSES['pain'])})"


def indication() -> str:
    """Any purpose phrase.

    Kinds are ordered so that a phrase that continues another one comes first: set phrases,
    control, risk, pains ("bowel pain"), amounts ("thyroid levels"), complaints ("heart
    disease"), parts of the body ("heart").
    """
    of = {kind: any_of(items) for kind, items in vocab.PURPOSES.items()}
    sink = any_of(vocab.PURPOSES["sink"] + vocab.PURPOSES["either"])
    rise = any_of(vocab.PURPOSES["rise"] + vocab.PURPOSES["either"])
    high, low, your_low = "(?:(?:your|high|raised|excess) )?", "(?:low )?", "(?:your )?(?:low )?"
    keep = f"{_HELP_DO} (?:improve|maintain|aid) {_YOUR}"
    avoid = f"{_HELP_DO} (?:reduce|lower|prevent) (?:(?:the|your) )?risk"
    pains = _pains()
    kinds = [
        *map(_phrase, _longest(vocab.SET_PURPOSES)),
        f"(?:{keep}|for {_YOUR}){of['controlled']} control",
        f"{avoid}(?: of {of['event']}(?: (?:and|or|/) {of['event']})?)?",
        _aim("pain", _YOUR, pains),
        f"for {_YOUR}{pains}",
        _aim("sink", high, sink),
        f"for {high}{sink}",
        _aim("rise", your_low, rise),
        f"for {low}{of['either']}",
        f"for {your_low}{of['rise']}",
        _aim("complaint", _YOUR, of["complaint"]),
        f"(?:for|to help) {_YOUR}{of['complaint']}",
        _aim("body", "your ", of["body"], helped=False),
        f"for your {of['body']}",
    ]
    return "(?:" + "|".join(kinds) + ")"


def site() -> str:
    """Any site phrase, with or without preposition, article, state and side."""
    states, sides = any_of(vocab.SITE_STATES), any_of(vocab.SITE_SIDES)
    parts = []
    for part, before, articles, stated, sided in vocab.SITE_PHRASES:
        lead = f"(?:{any_of(before.split())}(?: {any_of(articles.split())})? )?"
        parts.append(lead + f"(?:{states} )?" * bool(stated) + f"(?:{sides} )?" * bool(sided) + any_of([part]))
    return "(?:" + "|".join(parts) + ")"
