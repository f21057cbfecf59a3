import re

from posofold import vocab
from posofold.functions import phrases
from posofold.operators.numeric import configured_rules


def _found(pattern, text):
    hit = re.search(pattern, text)
    return hit and hit.group()


def test_longest_purpose_wins():
    cases = {
        "take 1 for your mood and sleep daily": "for your mood and sleep",
        "1 at night to help lower raised cholesterol": "to help lower raised cholesterol",
        "to reduce the risk of heart attacks and strokes": "to reduce the risk of heart attacks and strokes",
        "for your bladder control": "for your bladder control",
        "for severe back pain as needed": "for severe back pain",
        "for controlling blood pressure": "for controlling blood pressure",
        "to help reducing cardiovascular risk": "to help reducing cardiovascular risk",
        "for 7 days": None,
    }
    pattern = phrases.indication()
    assert {text: _found(pattern, text) for text in cases} == cases


def test_every_purpose_and_site_is_read():
    pattern = phrases.indication()
    for kind, items in vocab.PURPOSES.items():
        if kind in ("event", "controlled"):
            continue
        for item in items:
            for word in {item.removesuffix("(s)"), item.replace("(s)", "s")}:
                text = f"for your {word}" if kind == "body" else f"for {word}"
                assert _found(pattern, text) == text
    for text in vocab.SET_PURPOSES:
        assert re.fullmatch(pattern, text.replace("(s)", "s"))
    for part, before, *_ in vocab.SITE_PHRASES:
        for lead in before.split():
            text = f"{lead} the {part.replace('(s)', 's')}"
            assert re.fullmatch(phrases.site(), text)
    assert _found(phrases.site(), "1 drop into the affected left eye daily") == "into the affected left eye"


def test_forms_of_verbs():
    assert [phrases.ing(v) for v in ("reduce", "control", "treat")] == ["reducing", "controlling", "treating"]


def test_number_rules_in_order():
    rules = [(rule, argument) for name, rule, argument in configured_rules() if name == "frequencyBare_frequencyMax"]
    assert rules == [
        ("no_negatives", None), ("avoid_zero", None), ("below", "20"), ("must_be_whole_num", None),
        ("must_be_greater_than", "frequencyBare_frequency"),
    ]
    assert ("milligramMax_value", "avoid_zero", None) not in configured_rules()
