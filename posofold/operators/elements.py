"""The 29 token-pattern elements, declared in priority order.

An earlier element claims its tokens before a later one.  Each pattern is
``name: tokens -> wording``; the wording may use the captured fields, ``@span`` (the
matched text) and fixed field values given in ``fixed``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from posofold.functions.patterns import compile_pattern


@dataclass(frozen=True)
class Pattern:
    name: str
    tokens: str
    wording: str
    fixed: dict[str, str] = field(default_factory=dict)
    regex: str = ""
    groups: tuple[str, ...] = ()

    @staticmethod
    def of(name: str, tokens: str, wording: str, **fixed: str) -> Pattern:
        groups: list[str] = []
        regex = compile_pattern(tokens, groups)
        return Pattern(name, tokens, wording, fixed, regex, tuple(groups))

    @property
    def plain(self) -> str:
        """The regex without capture groups."""
        return compile_pattern(self.tokens)


@dataclass(frozen=True)
class Element:
    key: str
    fields: tuple[str, ...]
    patterns: tuple[Pattern, ...]
    # unit field -> field whose value decides between "tablet" and "tablets"
    plural_by: dict[str, str] = field(default_factory=dict)
    # a leading "N - N" is marked, because it may also be read as two numbers
    dashable: bool = False

    @property
    def any_match(self) -> str:
        return "|".join(p.plain for p in self.patterns)


def _element(key, fields, *patterns, plural_by=None, dashable=False) -> Element:
    return Element(key, tuple(fields.split()), tuple(patterns), plural_by or {}, dashable)


P = Pattern.of


def _frequency_patterns(lead: str = "") -> list[Pattern]:
    return [
        P("n_times", f"{lead}frequency=<INT> times <PER> period_unit=<PERIOD>",
          "{frequency} times every {period_unit}"),
        P("once", f"{lead}once <PER> period_unit=<PERIOD>", "once every {period_unit}", frequency="1"),
        P("n_to_m_times",
          f"{lead}frequency=<INT> to|or|- frequencyMax=<INT> ~time <PER> period_unit=<PERIOD>",
          "{frequency} to {frequencyMax} times every {period_unit}"),
        P("up_to_n_times", f"{lead}up to frequencyMax=<INT> ~time <PER> period_unit=<PERIOD>",
          "up to {frequencyMax} times every {period_unit}"),
        P("up_to_once", f"{lead}up to once <PER> period_unit=<PERIOD>",
          "up to once every {period_unit}", frequencyMax="1"),
    ]


def _when_patterns(lead: str = "") -> list[Pattern]:
    return [
        P("offset_range",
          f"{lead}offset=<INT> to|or|- offsetMax=<INT> period_unit=<PERIOD> <WHEN>", "@span", when="@span"),
        P("at_least_offset", f"{lead}at least offset=<INT> period_unit=<PERIOD> <WHEN>", "@span", when="@span"),
        P("offset", f"{lead}offset=<INT> period_unit=<PERIOD> <WHEN>", "@span", when="@span"),
        P("phrase", f"{lead}<WHEN>", "@span", when="@span"),
    ]


_MAX = "up? to? a? max|maximum of? num_value=<QTY> num_unit=<UNIT>"
_NO_MORE = "not|no more than num_value=<QTY> num_unit=<UNIT>"
_PER_PERIOD = "up to a maximum of {num_value} {num_unit} in {denom_value} {denom_unit}"
_PER_DOSE = "up to a maximum of {value} {unit} per dose"
_LIFETIME = "in|per|for the? lifetime of? the? patient?"
_PER_LIFETIME = "up to a maximum of {value} {unit} for the lifetime of patient"

ELEMENTS: tuple[Element, ...] = (
    _element(
        "methodDirect", "verb",
        P("phrase", "to? verb=<PHRASE_VERB>", "{verb}"),
        P("verb", "to? verb=<VERB>", "{verb}"),
    ),
    _element(
        "methodPassive", "verb",
        P("to_be_done", "to be verb=<DONE>", "{verb}"),
        P("done", "verb=<DONE>", "{verb}"),
    ),
    _element(
        "rateRatio", "numerator denominator period_unit",
        P("per", "at a rate of numerator=<NUM> per period_unit=<PERIOD>",
          "at a rate of {numerator} per {period_unit}"),
        P("every_n", "at a rate of numerator=<NUM> every denominator=<NUM> period_unit=<PERIOD>",
          "at a rate of {numerator} every {denominator} {period_unit}"),
    ),
    _element(
        "rateRange", "low high special_unit",
        P("range", "at a rate of low=<NUM> to high=<NUM> special_unit=<FLOW>",
          "at a rate of {low} to {high} {special_unit}"),
    ),
    _element(
        "rateQuantity", "value special_unit",
        P("value", "at a rate of value=<NUM> special_unit=<FLOW>", "at a rate of {value} {special_unit}"),
    ),
    _element(
        "durationValue", "value period_units",
        P("over", "over value=<INT> period_units=<PERIOD_TO_DAY>", "over {value} {period_units}"),
    ),
    _element(
        "durationMax", "value period_units",
        P("maximum", "maximum|max value=<INT> period_units=<PERIOD>", "maximum {value} {period_units}"),
    ),
    _element("frequencyWithMethod", "frequency frequencyMax period_unit", *_frequency_patterns("to be <DONE> ")),
    _element("frequencyBare", "frequency frequencyMax period_unit", *_frequency_patterns(), dashable=True),
    _element(
        "timeOfDay", "value",
        P("half_day", "at <HOUR12> <NL>? <HALFDAY>", "@span", value="@span"),
        P("clock", "at <CLOCK>", "@span", value="@span"),
    ),
    _element("dayOfWeek", "value", P("weekday", "on <WEEKDAY>", "@span", value="@span")),
    _element(
        "maxDosePerPeriod", "num_value num_unit denom_value denom_unit",
        P("max_in_n", f"{_MAX} in denom_value=<INT> denom_unit=<PERIOD_TO_WEEK>", _PER_PERIOD),
        P("max_in_a", f"{_MAX} in a denom_unit=<PERIOD_TO_WEEK>", _PER_PERIOD, denom_value="1"),
        P("max_per", f"{_MAX} <PER> denom_unit=<PERIOD_TO_WEEK>", _PER_PERIOD, denom_value="1"),
        P("no_more_in_n", f"{_NO_MORE} in denom_value=<INT> denom_unit=<PERIOD_TO_WEEK>", _PER_PERIOD),
        P("no_more_in_a", f"{_NO_MORE} in a denom_unit=<PERIOD_TO_WEEK>", _PER_PERIOD, denom_value="1"),
        P("no_more_per", f"{_NO_MORE} <PER> denom_unit=<PERIOD_TO_WEEK>", _PER_PERIOD, denom_value="1"),
        plural_by={"num_unit": "num_value"},
    ),
    _element(
        "maxDosePerAdministration", "value unit",
        P("max", "up to a max|maximum of value=<QTY> unit=<UNIT> per dose", _PER_DOSE),
        P("no_more", "not|no more than value=<QTY> unit=<UNIT> per dose", _PER_DOSE),
        plural_by={"unit": "value"},
    ),
    _element(
        "maxDosePerLifetime", "value unit",
        P("up_to_max", f"up to a max|maximum of value=<QTY> unit=<UNIT> {_LIFETIME}", _PER_LIFETIME),
        P("max", f"max|maximum of value=<QTY> unit=<UNIT> {_LIFETIME}", _PER_LIFETIME),
        P("no_more", f"not|no more than value=<QTY> unit=<UNIT> {_LIFETIME}", _PER_LIFETIME),
        plural_by={"unit": "value"},
    ),
    _element(
        "periodElement", "period periodMax period_units frequency",
        P("every_n_to_m", "<PER> period=<INT> to|-|or periodMax=<INT> period_units=<PERIOD_TO_MONTH>",
          "once every {period} to {periodMax} {period_units}", frequency="1"),
        P("every_1", "<PER> 1 period_units=<PERIOD_TO_MONTH>", "once every {period_units}",
          period="1", frequency="1"),
        P("every_n", "<PER> period=<INT> period_units=<PERIOD_TO_MONTH>",
          "once every {period} {period_units}", frequency="1"),
        P("every_other", "<PER> other period_units=<PERIOD_TO_MONTH>", "once every 2 {period_units}s",
          period="2", frequency="1"),
        P("alternate", "on? alternate period_units=<PERIOD_TO_MONTH>", "once every 2 {period_units}",
          period="2", frequency="1"),
        P("every", "<PER> period_units=<PERIOD_TO_MONTH>", "once every {period_units}",
          period="1", frequency="1"),
    ),
    _element("whenWithMethod", "when offset offsetMax period_unit", *_when_patterns("to be <DONE> ")),
    _element("whenBare", "when offset offsetMax period_unit", *_when_patterns(), dashable=True),
    _element(
        "boundsDuration", "value unit low high low_unit high_unit",
        P("for_n_to_m", "for low=<INT> to|-|or high=<INT> high_unit=<PERIOD_FROM_HOUR>",
          "for {low} to {high} {high_unit}"),
        P("for_n", "for value=<INT> unit=<PERIOD_FROM_HOUR>", "for {value} {unit}"),
        P("for_at_least", "for at least low=<INT> low_unit=<PERIOD_FROM_HOUR>", "for at least {low} {low_unit}"),
        P("for_up_to", "for up to high=<INT> high_unit=<PERIOD_FROM_HOUR>", "for up to {high} {high_unit}"),
    ),
    _element(
        "boundsPeriod", "start end",
        P("day_first", "from start=<DMY> to end=<DMY>", "from {start} to {end}"),
        P("year_first", "from start=<YMD> to end=<YMD>", "from {start} to {end}"),
    ),
    _element(
        "boundsAPeriodStartEnd", "start end",
        P("from_day_first", "from start=<DMY>", "from {start}"),
        P("from_year_first", "from start=<YMD>", "from {start}"),
        P("until_day_first", "until end=<DMY>", "until {end}"),
        P("until_year_first", "until end=<YMD>", "until {end}"),
    ),
    _element(
        "event", "value",
        P("day_first", "on value=<DMY>", "on {value}"),
        P("year_first", "on value=<YMD>", "on {value}"),
    ),
    _element(
        "count", "count countMax",
        P("n_to_m_times", "count=<INT> to|or countMax=<INT> ~time", "{count} to {countMax} times"),
        P("up_to_n_times", "up to countMax=<INT> ~time", "up to {countMax} times"),
        P("n_times", "count=<INT> ~time", "{count} times"),
        P("once", "once", "once", count="1"),
        dashable=True,
    ),
    _element(
        "doseRange", "low high units spoonsize",
        P("spoons", "low=<DIGIT> or|to|- high=<DIGIT> x? <NL>? spoonsize=<SIZE> <NL>? <ML> units=<SPOON>",
          "{low} to {high} x {spoonsize}ml spoonfuls"),
        P("units", "low=<QTY> to|or|- high=<QTY> units=<UNIT>", "{low} to {high} {units}"),
        P("up_to", "up to high=<DIGIT> units=<UNIT>", "up to {high} {units}"),
        plural_by={"units": "high"}, dashable=True,
    ),
    _element(
        "doseQuantity", "quantity units spoonsize",
        P("spoons", "quantity=<DIGIT> x? <NL>? spoonsize=<SIZE> <NL>? <ML> units=<SPOON>",
          "{quantity} x {spoonsize}ml spoonfuls"),
        P("units", "quantity=<QTY> units=<UNITS>", "{quantity} {units}"),
        plural_by={"units": "quantity"}, dashable=True,
    ),
    _element(
        "doseXMilliValueOnly", "value val_milli milli",
        P("times_metric", "value=<INT> <NL>? x <NL>? val_milli=<NUM> <NL>? milli=<METRIC>",
          "{value} x {val_milli} {milli}"),
        dashable=True,
    ),
    _element(
        "milligramMax", "value valueMax milligram_units low_unit",
        P("two_units", "value=<QTY> low_unit=<METRIC> or|to|- valueMax=<QTY> milligram_units=<METRIC>",
          "{value} to {valueMax} {milligram_units}"),
        P("one_unit", "value=<QTY> or|to valueMax=<QTY> milligram_units=<METRIC>",
          "{value} to {valueMax} {milligram_units}"),
        dashable=True,
    ),
    _element(
        "milligramValue", "value milligram_units",
        P("metric", "value=<QTY> milligram_units=<METRIC>", "{value} {milligram_units}"),
    ),
    _element(
        "dose_QuantityValueAndMaxOnly", "value valueMax",
        P("range", "value=<QTY> or|to|- valueMax=<QTY>", "{value} to {valueMax}"),
        dashable=True,
    ),
    _element("dose_QuantityValueOnly", "value", P("number", "value=<QTY>", "{value}")),
)

BY_KEY = {e.key: e for e in ELEMENTS}
KEYS = tuple(e.key for e in ELEMENTS)

# Elements whose tokens contain another element that still claims first: the method is
# read on its own, and the longer reading is restored afterwards.
SHORTER_FIRST = (
    ("methodDirect", "frequencyWithMethod"),
    ("methodPassive", "frequencyWithMethod"),
    ("methodDirect", "whenWithMethod"),
    ("methodPassive", "whenWithMethod"),
    ("methodDirect", "doseQuantity"),
)

REGEX_ELEMENTS = (
    "extras_b", "extrasAsDirected", "extras", "extrasPAUSE", "extrasALTER",
    "asNeededCodeableConcept", "asNeededBoolean", "forElement", "route", "site",
)

# Order in which the cleaned elements are joined into the bucket text.
BUCKET_ORDER = (
    "methodPassive", "methodDirect", "doseQuantity", "dose_QuantityValueOnly", "milligramValue",
    "doseXMilliValueOnly", "doseRange", "dose_QuantityValueAndMaxOnly", "milligramMax", "rateRatio",
    "rateQuantity", "rateRange", "durationValue", "durationMax", "frequencyBare",
    "frequencyWithMethod", "periodElement", "count", "whenBare", "whenWithMethod", "dayOfWeek",
    "timeOfDay", "route", "site", "asNeededCodeableConcept", "asNeededBoolean", "boundsDuration",
    "boundsPeriod", "boundsAPeriodStartEnd", "event", "maxDosePerPeriod",
    "maxDosePerAdministration", "maxDosePerLifetime", "extras", "extrasAsDirected", "extrasPAUSE",
    "extrasALTER", "extras_b", "forElement",
)


def element_columns(element: Element) -> list[str]:
    return [f"{element.key}_clean", f"{element.key}_captured"] + [f"{element.key}_{f}" for f in element.fields]


ALL_COLUMNS = [c for e in ELEMENTS for c in element_columns(e)]
