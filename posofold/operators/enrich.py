"""From the element columns to the consolidated, coded lookup (138 columns)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold.functions import coding
from posofold.functions.fence import fence
from posofold.functions.text import filled, with_missing
from posofold.operators.elements import ALL_COLUMNS, BY_KEY, KEYS, REGEX_ELEMENTS
from posofold.operators.fhir import add_dosage, with_text

INPUT = [
    *ALL_COLUMNS,
    *[f"{e}_clean" for e in REGEX_ELEMENTS],
    "extras_whenoffset",
    "dosage",
    "dosage_lower",
    "dosage_elements",
    "exclude",
    "buckets",
    "dosage_spare",
]


@cache
def _dose() -> dict[str, Column]:
    """Dose value and unit, always both from the same element."""
    quantity, bare, metric = (
        F.col("doseQuantity_quantity").isNotNull(),
        F.col("dose_QuantityValueOnly_value").isNotNull(),
        F.col("milligramValue_value").isNotNull(),
    )
    ranged, bare_range, metric_range = (
        filled(F.col("doseRange_clean")),
        F.col("dose_QuantityValueAndMaxOnly_value").isNotNull(),
        F.col("milligramMax_value").isNotNull(),
    )
    unit_range = (
        F.when(ranged, F.col("doseRange_units"))
        .when(bare_range, F.lit(None).cast("string"))
        .when(metric_range, F.col("milligramMax_milligram_units"))
    )
    return {
        "doseQuantity_value": F.when(quantity, F.col("doseQuantity_quantity"))
        .when(bare, F.col("dose_QuantityValueOnly_value"))
        .when(metric, F.col("milligramValue_value")),
        "doseQuantity_unit": F.when(quantity, F.col("doseQuantity_units"))
        .when(bare, F.lit(None).cast("string"))
        .when(metric, F.col("milligramValue_milligram_units")),
        "doseRange_low": F.when(ranged, F.col("doseRange_low"))
        .when(bare_range, F.col("dose_QuantityValueAndMaxOnly_value"))
        .when(metric_range, F.col("milligramMax_value")),
        "doseRange_high": F.when(ranged, F.col("doseRange_high"))
        .when(bare_range, F.col("dose_QuantityValueAndMaxOnly_valueMax"))
        .when(metric_range, F.col("milligramMax_valueMax")),
        "doseRange_lowunit": unit_range,
        "doseRange_highunit": unit_range,
    }


# published column -> the element fields that can supply it, the first one present wins
MERGED: dict[str, tuple[str, ...]] = {
    "doseXMilli_value": ("doseXMilliValueOnly_value",),
    "doseXMilli_valMilli": ("doseXMilliValueOnly_val_milli",),
    "doseXMilli_milli": ("doseXMilliValueOnly_milli",),
    "milligram_value": ("milligramValue_value", "milligramMax_value"),
    "milligram_valueMax": ("milligramMax_valueMax",),
    "milligram_units": ("milligramValue_milligram_units", "milligramMax_milligram_units"),
    "method_verb": ("methodDirect_verb", "methodPassive_verb"),
    "rateRatio_periodUnit": ("rateRatio_period_unit",),
    "rateRange_unit": ("rateRange_special_unit",),
    "rateQuantity_unit": ("rateQuantity_special_unit",),
    "frequency_value": ("frequencyBare_frequency", "frequencyWithMethod_frequency", "periodElement_frequency"),
    "frequency_valueMax": ("frequencyBare_frequencyMax", "frequencyWithMethod_frequencyMax"),
    "frequency_periodUnit": ("frequencyBare_period_unit", "frequencyWithMethod_period_unit"),
    "period_value": ("periodElement_period",),
    "period_valueMax": ("periodElement_periodMax",),
    "period_units": ("periodElement_period_units",),
    "duration_value": ("durationValue_value",),
    "duration_valueMax": ("durationMax_value",),
    "duration_units": ("durationValue_period_units", "durationMax_period_units"),
    "when_value": ("whenBare_when", "whenWithMethod_when"),
    "when_offset": ("whenBare_offset", "whenWithMethod_offset"),
    "when_periodUnit": ("whenBare_period_unit", "whenWithMethod_period_unit"),
    "boundsPeriod_start": ("boundsPeriod_start", "boundsAPeriodStartEnd_start"),
    "boundsPeriod_end": ("boundsPeriod_end", "boundsAPeriodStartEnd_end"),
}


# published unit column -> the column that it is taken from
_CODED_UNITS = {
    "rateRange_unit": "rateRange_special_unit",
    "rateQuantity_unit": "rateQuantity_special_unit",
    "maxDosePerPeriod_num_unit": "maxDosePerPeriod_num_unit",
    "maxDosePerAdministration_unit": "maxDosePerAdministration_unit",
    "maxDosePerLifetime_unit": "maxDosePerLifetime_unit",
}
_PERIODS = (
    "rateRatio_periodUnit",
    "frequency_periodUnit",
    "period_units",
    "duration_units",
    "when_periodUnit",
    "boundsDuration_unit",
    "maxDosePerPeriod_denom_unit",
)


@cache
def _units() -> dict[str, Column]:
    """Coded units as structs, so that code, display and system need one lookup."""
    spoon = F.coalesce("doseQuantity_spoonsize", "doseRange_spoonsize")
    dose = F.coalesce("_new_doseQuantity_unit", "_new_doseRange_lowunit")
    out = {"_unit_dose": coding.unit(dose, spoon)}
    out.update({f"_unit_{name}": coding.unit(F.coalesce(source)) for name, source in _CODED_UNITS.items()})
    out["_coded_method"] = coding.method(F.col("_new_method_verb"))
    out["_coded_route"] = coding.route(F.col("route_clean"))
    return out


@cache
def _codes() -> dict[str, Column]:
    def display(term: str, text: str) -> Column:
        return F.coalesce(F.col(term)["display"], F.when(filled(F.col(text)), F.col(text)))

    out = {
        "dose_unit_all": F.array_compact(F.array("doseQuantity_unit", "doseRange_lowunit")),
        "method_snomed_code": F.col("_coded_method")["code"],
        "method_snomed_display": display("_coded_method", "method_verb"),
        "when_fhir": F.when(
            coding.when("when_value")["kind"] == "timing", coding.when("when_value")["value"]
        ),
        "dayOfWeek_fhir": F.array_join(coding.weekdays(F.col("dayOfWeek_value")), ", "),
        "route_snomed_code": F.col("_coded_route")["code"],
        "route_snomed_display": display("_coded_route", "route_clean"),
    }
    for name, unit in {"dose_unit": "_unit_dose", **{n: f"_unit_{n}" for n in _CODED_UNITS}}.items():
        out.update({f"{name}_{part}": F.col(unit)[part] for part in ("code", "display", "system")})
    for name in _PERIODS:
        out[f"{name}_ucum"] = coding.period_ucum(F.col(name))
    return out


# Published columns, in order.
_UNIT3 = ("code", "display", "system")
OUTPUT: tuple[str, ...] = (
    *"dosage dosage_lower dosage_count dosage_elements exclude mapped buckets fhir_json".split(),
    *"fhir_json_no_text dosage_spare".split(),
    *"doseQuantity_value doseQuantity_unit doseQuantity_spoonsize doseRange_low doseRange_high".split(),
    *"doseRange_lowunit doseRange_highunit doseRange_spoonsize dose_unit_all".split(),
    *[f"dose_unit_{p}" for p in _UNIT3],
    *"doseXMilli_value doseXMilli_valMilli doseXMilli_milli".split(),
    *"milligram_value milligram_valueMax milligram_units".split(),
    *"method_verb method_snomed_code method_snomed_display".split(),
    *"rateRatio_numerator rateRatio_denominator rateRatio_periodUnit rateRatio_periodUnit_ucum".split(),
    *"rateRange_low rateRange_high rateRange_unit".split(),
    *[f"rateRange_unit_{p}" for p in _UNIT3],
    *"rateQuantity_value rateQuantity_unit".split(),
    *[f"rateQuantity_unit_{p}" for p in _UNIT3],
    *"frequency_value frequency_valueMax frequency_periodUnit frequency_periodUnit_ucum".split(),
    *"count_count count_countMax period_value period_valueMax period_units period_units_ucum".split(),
    *"duration_value duration_valueMax duration_units duration_units_ucum".split(),
    *"when_value when_fhir when_offset when_periodUnit when_periodUnit_ucum".split(),
    *"dayOfWeek_value dayOfWeek_fhir timeOfDay_value event_value".split(),
    *"boundsDuration_value boundsDuration_unit boundsDuration_unit_ucum boundsDuration_low".split(),
    *"boundsDuration_high boundsDuration_low_unit boundsDuration_high_unit".split(),
    *"boundsPeriod_start boundsPeriod_end".split(),
    *"maxDosePerPeriod_num_value maxDosePerPeriod_num_unit".split(),
    *[f"maxDosePerPeriod_num_unit_{p}" for p in _UNIT3],
    *"maxDosePerPeriod_denom_value maxDosePerPeriod_denom_unit maxDosePerPeriod_denom_unit_ucum".split(),
    *"maxDosePerAdministration_value maxDosePerAdministration_unit".split(),
    *[f"maxDosePerAdministration_unit_{p}" for p in _UNIT3],
    *"maxDosePerLifetime_value maxDosePerLifetime_unit".split(),
    *[f"maxDosePerLifetime_unit_{p}" for p in _UNIT3],
    *"route_clean route_snomed_code route_snomed_display site_clean asNeededBoolean_clean".split(),
    *"extrasAsDirected_clean extras_clean extrasPAUSE_clean extrasALTER_clean extras_b_clean".split(),
    *"extras_whenoffset forElement_clean asNeededCodeableConcept_clean".split(),
    *[f"{k}_clean" for k in sorted(KEYS, key=str.lower)],
)


def published_as(key: str) -> str | None:
    """The published column that is filled when the element is present: the leading part of a
    dose, a column that only this element supplies, or else the first one that it shares."""
    dose = [c for c in _dose() if c.startswith(f"{key}_")]
    fields = {f"{key}_{f}" for f in BY_KEY[key].fields}
    supplied = {c: fields.intersection(MERGED.get(c, (c,))) for c in OUTPUT}
    alone = [c for c, own in supplied.items() if own and fields.issuperset(MERGED.get(c, (c,)))]
    return next(iter([*dose, *alone, *[c for c, own in supplied.items() if own]]), None)


def refine(lookup: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Consolidate, code and add the FHIR dosage; rows keep their partition.

    ``extra`` are further columns to compute from the lookup's own and to keep.
    """
    df = with_missing(lookup, INPUT)
    df = with_missing(df, ["dosage_count"], "bigint")
    df = with_missing(df, ["mapped"], "boolean")
    # everything is computed from the source columns before any of them is replaced
    df = df.withColumns(extra) if extra else df
    # F.coalesce: a field of the first element that is present, be it empty there
    merged = {name: F.coalesce(*fields) if len(fields) > 1 else F.col(fields[0]) for name, fields in MERGED.items()}
    new = {**_dose(), **merged}
    df = df.withColumns({f"_new_{name}": column for name, column in new.items()})
    df = df.withColumns(_units())
    df = fence(add_dosage(df, "fhir_json_no_text"), "fhir_json_no_text")
    df = df.withColumns({name: F.col(f"_new_{name}") for name in new})
    body = F.when(F.col("mapped"), F.col("fhir_json_no_text"))
    df = df.withColumns(
        {**_codes(), "fhir_json_no_text": body, "fhir_json": F.when(body.isNotNull(), with_text(F.col("dosage"), body))}
    )
    return df.select(*OUTPUT, *(extra or ()))
