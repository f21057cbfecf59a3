"""FHIR STU3 Dosage as nested structs and JSON.

Works in four projections on the refined columns (``_new_*``) and the element columns:
coded terms, single fields, objects, JSON.  Each uses only names of the one before, so
no expression is repeated inside another.  Absent parts are NULL and left out of the JSON.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions import coding
from posofold.functions.coding import SNOMED, UCUM
from posofold.functions.text import filled, lookup, number

_DESCRIPTION_URL = "https://fhir.hl7.org.uk/STU3/StructureDefinition/Extension-coding-sctdescid"
_EXTRAS = (
    "extrasAsDirected_clean", "extras_clean", "extrasPAUSE_clean", "extrasALTER_clean",
    "extras_b_clean", "extras_whenoffset", "forElement_clean",
)


def _c(name: str) -> Column:
    return F.col(name)


def _has(element: str) -> Column:
    return filled(_c(f"{element}_clean"))


def _text(value: Column) -> Column:
    """The value, NULL where it is empty."""
    return F.when(filled(value), value)


def json_number(value: Column) -> Column:
    """A number for JSON: 2 for "2" and "2.0", 2.5 for "2.5"."""
    n = number(value)
    whole = n.try_cast("bigint").cast("string")
    return F.try_parse_json(F.when(n == F.floor(n), whole).otherwise(n.cast("string")))


def _integer(value: Column) -> Column:
    return number(value).try_cast("bigint")


def _object(*names: str) -> Column:
    """Struct of the named columns (``_f_x`` gives field x), NULL when all are NULL."""
    some = F.coalesce(*[F.when(_c(n).isNotNull(), F.lit(True)) for n in names])
    return F.when(some, F.struct(*[_c(n).alias(n.split("_")[-1]) for n in names]))


def _coding(term: Column) -> Column:
    return F.array(F.struct(F.lit(SNOMED).alias("system"), term["code"].alias("code"), term["display"].alias("display")))


def _concept(term: Column, text: Column) -> Column:
    """Coded where there is a code, with the text otherwise."""
    return F.when(
        term.isNotNull() | text.isNotNull(),
        F.struct(F.when(term.isNotNull(), _coding(term)).alias("coding"), text.alias("text")),
    )


def _quantity(value: str, unit: str | None) -> Column:
    """Value with a coded unit struct."""
    parts = [_c(value).alias("value")]
    for part, name in (("display", "unit"), ("system", "system"), ("code", "code")):
        parts.append((_c(unit)[part] if unit else F.lit(None).cast("string")).alias(name))
    return F.when(_c(value).isNotNull(), F.struct(*parts))


def _either(name: str, first: str, second: str) -> Column:
    return F.when(_has(first), _c(f"{first}_{name}")).when(_has(second), _c(f"{second}_{name}"))


def _frequency(name: str) -> Column:
    return _either(name, "frequencyBare", "frequencyWithMethod")


def _when(name: str) -> Column:
    return _either(name, "whenBare", "whenWithMethod")


def _ucum(unit: Column) -> Column:
    """UCUM code by exact spelling, else the unit as is."""
    return F.coalesce(lookup(vocab.PERIOD_UCUM, unit), unit)


# minutes in an offset unit; any other spelling counts as minutes
_OFFSET_MINUTES = {"minute": 1.0, "hour": 60.0, "day": 1440.0, "week": 10080.0}


def offset_minutes(amount: Column, unit: Column) -> Column:
    minutes = number(amount) * F.coalesce(lookup(_OFFSET_MINUTES, unit), F.lit(1.0))
    return F.nullif(minutes.try_cast("bigint"), F.lit(0).cast("bigint"))


def clock_times(text: Column) -> Column:
    """HH:MM list of the clock times in a text; "noon" counts when nothing else does."""
    low = F.lower(text)
    full = F.transform(
        F.regexp_extract_all(low, F.lit(r"(\d{1,2}:\d{2})"), F.lit(1)), lambda t: F.lpad(t, 5, "0")
    )
    half = F.transform(
        F.regexp_extract_all(low, F.lit(r"(\d{1,2}\s*(?:am|pm))"), F.lit(1)),
        lambda t: _clock(F.regexp_extract(t, r"^\d+", 0).cast("int"), t.endswith("pm")),
    )
    times = F.concat(full, half)
    noon = F.when((F.size(times) == 0) & low.contains("noon"), F.array(F.lit("12:00")))
    return F.when(F.size(times) > 0, times).otherwise(noon)


def _clock(hour: Column, afternoon: Column) -> Column:
    hour = F.when(afternoon & (hour != 12), hour + 12).when(~afternoon & (hour == 12), 0).otherwise(hour)
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def _patient_instruction() -> Column:
    """Strength given beside the dose, in brackets."""
    dosed = _has("doseQuantity") | _has("dose_QuantityValueOnly") | _has("doseRange")

    def bracket(element: str, amount: Column) -> Column:
        unit = F.coalesce(_text(_c(f"{element}_milligram_units")), F.lit("mg"))
        text = F.concat(F.lit("("), amount, F.lit(" "), unit, F.lit(")"))
        return F.when(_has(element) & dosed & filled(_c(f"{element}_value")), text)

    high = F.when(filled(_c("milligramMax_valueMax")), F.concat(F.lit("-"), "milligramMax_valueMax"))
    ranged = F.concat(F.col("milligramMax_value"), F.coalesce(high, F.lit("")))
    both = F.concat_ws(" ", bracket("milligramValue", _c("milligramValue_value")), bracket("milligramMax", ranged))
    return _text(both)


@cache
def _terms() -> dict[str, Column]:
    verb = F.when(_has("methodDirect"), _c("methodDirect_verb")).when(
        _has("methodPassive"), _c("methodPassive_verb")
    )
    return {
        "_unit_xmilli": coding.unit(_c("doseXMilliValueOnly_milli")),
        "_unit_per_period": coding.unit(_c("maxDosePerPeriod_num_unit")),
        "_unit_per_dose": coding.unit(_c("maxDosePerAdministration_unit")),
        "_unit_lifetime": coding.unit(_c("maxDosePerLifetime_unit")),
        "_verb": verb,
        "_method": coding.method(verb),
        "_route": coding.route(_c("route_clean")),
        "_site": coding.site("site_clean"),
        "_indication": coding.indication("asNeededCodeableConcept_clean"),
        "_when_text": _when("when"),
        "_when_offset": _text(_when("offset")),
        "_rate_unit": _text(_c("rateRatio_period_unit")),
        "_range_unit": F.coalesce(
            _text(_c("boundsDuration_low_unit")), _text(_c("boundsDuration_high_unit"))
        ),
        "_max_unit": _text(_c("maxDosePerPeriod_denom_unit")),
        "_bounds_unit": _text(_c("boundsDuration_unit")),
        **{f"_extra_{name}": coding.extra(_c(name)) for name in _EXTRAS},
    }


@cache
def _fields() -> dict[str, Column]:
    """The single fields; ``_is_*`` tells which dose element decides."""
    per = _text(_frequency("period_unit"))
    every = _has("periodElement")
    unit = F.coalesce(F.when(every, _ucum(_text(_c("periodElement_period_units")))), _ucum(per))
    length = F.when(per == "fortnight", 2).when(per.isNotNull(), 1).cast("bigint")
    when = coding.when("_when_text")
    bounds = _has("boundsDuration")
    fixed = filled(_c("boundsDuration_value")) & _c("_bounds_unit").isNotNull()
    single, both = _has("boundsAPeriodStartEnd"), _has("boundsPeriod")

    def bound(end: str) -> Column:
        return F.coalesce(
            F.when(single, _text(_c(f"boundsAPeriodStartEnd_{end}"))),
            F.when(both, _text(_c(f"_new_boundsPeriod_{end}"))),
        )

    order = ("doseQuantity", "doseRange", "dose_QuantityValueAndMaxOnly", "doseXMilliValueOnly",
             "dose_QuantityValueOnly", "milligramValue", "milligramMax")
    decides = F.coalesce(*[F.when(_has(e), F.lit(e)) for e in order])
    return {
        "_is_dose": decides,
        "_when_kind": when,
        "_f_frequency": F.coalesce(
            _integer(_frequency("frequency")), F.when(every, _integer(_c("periodElement_frequency")))
        ),
        "_f_frequencyMax": _integer(_frequency("frequencyMax")),
        "_f_period": F.coalesce(
            F.when(every, _integer(_c("periodElement_period"))),
            length,
            F.when(unit.isNotNull(), F.lit(1).cast("bigint")),
        ),
        "_f_periodMax": F.when(every, _integer(_c("periodElement_periodMax"))),
        "_f_periodUnit": unit,
        "_f_count": F.when(_has("count"), _integer(_c("count_count"))),
        "_f_countMax": F.when(_has("count"), _integer(_c("count_countMax"))),
        "_f_duration": F.when(_has("durationValue"), json_number(_c("durationValue_value"))),
        "_f_durationMax": F.when(_has("durationMax"), json_number(_c("durationMax_value"))),
        "_f_durationUnit": F.coalesce(
            F.when(_has("durationValue"), _ucum(_text(_c("durationValue_period_units")))),
            F.when(_has("durationMax"), _ucum(_text(_c("durationMax_period_units")))),
        ),
        "_f_dayOfWeek": F.when(_has("dayOfWeek"), coding.weekdays(_c("dayOfWeek_value"))),
        "_f_timeOfDay": F.when(_has("timeOfDay"), clock_times(_c("timeOfDay_value"))),
        "_f_event": F.when(_has("event") & filled(_c("event_value")), F.array("event_value")),
        "_f_start": bound("start"),
        "_f_end": bound("end"),
        "_n_bounds": F.when(bounds & fixed, json_number(_c("boundsDuration_value"))),
        "_n_bounds_low": F.when(bounds & ~fixed, json_number(_text(_c("boundsDuration_low")))),
        "_n_bounds_high": F.when(bounds & ~fixed, json_number(_text(_c("boundsDuration_high")))),
        "_n_dose": json_number(
            F.when(
                decides == "doseXMilliValueOnly",
                F.coalesce(_text(_c("doseXMilliValueOnly_val_milli")), _c("doseXMilliValueOnly_value")),
            ).otherwise(_c("_new_doseQuantity_value"))
        ),
        "_n_low": json_number(_c("_new_doseRange_low")),
        "_n_high": json_number(_c("_new_doseRange_high")),
        "_n_numerator": json_number(_c("rateRatio_numerator")),
        "_n_denominator": F.coalesce(json_number(_c("rateRatio_denominator")), F.parse_json(F.lit("1"))),
        "_n_rate_low": json_number(_c("rateRange_low")),
        "_n_rate_high": json_number(_c("rateRange_high")),
        "_n_rate": json_number(_c("rateQuantity_value")),
        "_n_max": json_number(_c("maxDosePerPeriod_num_value")),
        "_n_max_per": json_number(_c("maxDosePerPeriod_denom_value")),
        "_n_per_dose": json_number(_c("maxDosePerAdministration_value")),
        "_n_lifetime": json_number(_c("maxDosePerLifetime_value")),
        "_f_patientInstruction": _patient_instruction(),
    }


def _period_quantity(value: str, unit: str) -> Column:
    """Value in a period unit with its UCUM code."""
    return F.struct(
        _c(value).alias("value"),
        _c(unit).alias("unit"),
        F.when(_c(unit).isNotNull(), F.lit(UCUM)).alias("system"),
        _ucum(_c(unit)).alias("code"),
    )


def _flow(value: str, unit: str) -> Column:
    return F.when(_c(value).isNotNull(), F.struct(_c(value).alias("value"), _text(_c(unit)).alias("unit")))


@cache
def _objects() -> dict[str, Column]:
    """Quantities and other small objects."""
    is_one = _c("_is_dose").isin("doseQuantity", "dose_QuantityValueOnly", "milligramValue")
    is_metric = _c("_is_dose") == "doseXMilliValueOnly"
    is_range = _c("_is_dose").isin("doseRange", "dose_QuantityValueAndMaxOnly", "milligramMax")
    kind, offset = _c("_when_kind"), _c("_when_offset")
    timed = kind["kind"] == "timing"
    is_ratio, is_flow = _has("rateRatio"), _has("rateRange")
    # an offset says more than the code, so the wording is kept
    as_code = (kind["kind"] == "instruction") & offset.isNull()
    when_term = F.when(as_code, coding.instruction(kind["value"]))
    when_text = F.when(~timed & ~as_code, _c("_when_text"))
    site = _c("_site")
    description = F.array(
        F.struct(
            F.lit(_DESCRIPTION_URL).alias("url"),
            F.array(
                F.struct(F.lit("descriptionDisplay").alias("url"), site["description"].alias("valueString"))
            ).alias("extension"),
        )
    )
    site_coding = F.array(
        F.struct(
            F.lit(SNOMED).alias("system"),
            site["code"].alias("code"),
            site["display"].alias("display"),
            description.alias("extension"),
        )
    )

    def extra(name: str) -> Column:
        term = _c(f"_extra_{name}")
        return _concept(term, F.when(term.isNull(), _text(_c(name))))

    listed = F.array_compact(F.array(_concept(when_term, when_text), *[extra(n) for n in _EXTRAS]))
    range_end = {
        end: F.when(is_range, _quantity(f"_n_{end}", "_unit_dose")) for end in ("low", "high")
    }
    return {
        "_f_when": F.when(timed, F.array(kind["value"])),
        "_f_offset": F.when(timed, offset_minutes(offset, _when("period_unit"))),
        "_f_boundsDuration": F.when(_c("_n_bounds").isNotNull(), _period_quantity("_n_bounds", "_bounds_unit")),
        "_b_low": F.when(_c("_n_bounds_low").isNotNull(), _period_quantity("_n_bounds_low", "_range_unit")),
        "_b_high": F.when(_c("_n_bounds_high").isNotNull(), _period_quantity("_n_bounds_high", "_range_unit")),
        "_f_boundsPeriod": _object("_f_start", "_f_end"),
        "_f_doseQuantity": F.when(is_one, _quantity("_n_dose", "_unit_dose")).when(
            is_metric, _quantity("_n_dose", "_unit_xmilli")
        ),
        "_d_low": range_end["low"],
        "_d_high": range_end["high"],
        "_f_rateRatio": F.when(
            is_ratio,
            F.struct(
                F.struct(_c("_n_numerator").alias("value")).alias("numerator"),
                _period_quantity("_n_denominator", "_rate_unit").alias("denominator"),
            ),
        ),
        "_r_low": F.when(~is_ratio & is_flow, _flow("_n_rate_low", "rateRange_special_unit")),
        "_r_high": F.when(~is_ratio & is_flow, _flow("_n_rate_high", "rateRange_special_unit")),
        "_f_rateQuantity": F.when(
            ~is_ratio & ~is_flow & _has("rateQuantity"), _flow("_n_rate", "rateQuantity_special_unit")
        ),
        "_f_method": _concept(_c("_method"), F.when(_c("_method").isNull(), _text(_c("_verb")))),
        "_f_route": _concept(_c("_route"), F.when(_c("_route").isNull(), _text(_c("route_clean")))),
        "_f_site": F.when(
            filled(_c("site_clean")),
            F.struct(
                F.when(site.isNotNull(), site_coding).alias("coding"),
                F.when(site.isNull(), _c("site_clean")).alias("text"),
            ),
        ),
        "_f_asNeededCodeableConcept": _concept(_c("_indication"), _text(_c("asNeededCodeableConcept_clean"))),
        "_f_asNeededBoolean": F.when(
            _has("asNeededBoolean") & ~_has("asNeededCodeableConcept"), F.lit(True)
        ),
        "_m_numerator": F.when(_has("maxDosePerPeriod"), _quantity("_n_max", "_unit_per_period")),
        "_m_denominator": F.when(
            _has("maxDosePerPeriod") & (_c("_n_max_per").isNotNull() | _c("_max_unit").isNotNull()),
            _period_quantity("_n_max_per", "_max_unit"),
        ),
        "_f_maxDosePerAdministration": F.when(
            _has("maxDosePerAdministration"), _quantity("_n_per_dose", "_unit_per_dose")
        ),
        "_f_maxDosePerLifetime": F.when(_has("maxDosePerLifetime"), _quantity("_n_lifetime", "_unit_lifetime")),
        "_f_additionalInstruction": F.when(F.size(listed) > 0, listed),
    }


_REPEAT = (
    "frequency", "frequencyMax", "period", "periodMax", "periodUnit", "count", "countMax", "duration",
    "durationMax", "durationUnit", "when", "offset", "dayOfWeek", "timeOfDay", "boundsDuration",
    "boundsRange", "boundsPeriod",
)
# parts of the dosage in their order
PARTS = (
    "timing", "doseQuantity", "doseRange", "rateRatio", "rateRange", "rateQuantity", "method", "route",
    "site", "asNeededCodeableConcept", "asNeededBoolean", "maxDosePerPeriod",
    "maxDosePerAdministration", "maxDosePerLifetime", "additionalInstruction", "patientInstruction",
)


def add_dosage(df: DataFrame, name: str) -> DataFrame:
    """Add the dosage without its text as JSON column ``name``; needs ``_unit_dose``."""
    steps = [
        _terms(),
        _fields(),
        _objects(),
        {
            "_f_boundsRange": _object("_b_low", "_b_high"),
            "_f_doseRange": _object("_d_low", "_d_high"),
            "_f_rateRange": _object("_r_low", "_r_high"),
            "_f_maxDosePerPeriod": _object("_m_numerator", "_m_denominator"),
        },
        {"_f_repeat": _object(*[f"_f_{r}" for r in _REPEAT])},
        {"_f_timing": _object("_f_repeat", "_f_event")},
    ]
    for step in steps:
        df = df.withColumns(step)
    body = F.to_json(F.struct(*[_c(f"_f_{p}").alias(p) for p in PARTS]))
    df = df.withColumns({name: body})
    return df.drop(*[column for step in steps for column in step])


def with_text(text: Column, body: Column) -> Column:
    """Put the instruction text in front of the dosage body."""
    head = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("text")))
    rest = F.when(body == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substr(body, F.lit(2))))
    return F.concat(F.regexp_replace(head, r"\}$", ""), rest)
