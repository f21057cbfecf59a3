"""Rules that compare several fields of one instruction, as boolean columns."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.fence import fence
from posofold.functions.text import lookup, number, with_missing, word

_ONCE_A_DAY = "|".join(w for w, how, _ in vocab.WHEN_WORDS if how == "once")
_SEVERAL_A_DAY = "|".join(w for w, how, _ in vocab.WHEN_WORDS if how == "several")
# last word ends in "s" and is not one of the small words that do
_PLURAL = r"(?:^|\s)(?!(?:this|was|is|as|has|plus)\s*$)\S*s\s*$"
_EACH_DAILY = rf"^(?:each|every)\s+(?:{'|'.join(vocab.DAILY_WORDS)})$"

READS = """
doseQuantity_quantity doseQuantity_units doseRange_low doseRange_high doseRange_units
dose_QuantityValueOnly_value dose_QuantityValueAndMaxOnly_value
milligramMax_value milligramMax_valueMax milligramMax_low_unit milligramMax_milligram_units
maxDosePerPeriod_num_value frequencyBare_frequency frequencyBare_frequencyMax frequencyBare_period_unit
frequencyWithMethod_frequency frequencyWithMethod_frequencyMax frequencyWithMethod_period_unit
periodElement_period periodElement_periodMax periodElement_period_units periodElement_frequency
count_count whenBare_when whenWithMethod_when whenBare_captured whenWithMethod_captured
dayOfWeek_value timeOfDay_value event_value durationValue_value durationValue_period_units
durationMax_value durationMax_period_units boundsDuration_value boundsDuration_unit
boundsDuration_high boundsDuration_high_unit
""".split()


def _n(name: str) -> Column:
    return number(F.col(name))


def _w(name: str) -> Column:
    return word(F.col(name))


def _days(value: Column, unit: Column) -> Column:
    """Amount of a period unit in days; an unknown unit counts as one day."""
    return value * F.coalesce(lookup(vocab.PERIOD_DAYS, unit), F.lit(1.0))


def _some(amount: Column) -> Column:
    """The amount, or one where it is missing or zero."""
    return F.coalesce(F.nullif(amount, F.lit(0.0)), F.lit(1.0))


@cache
def _facts() -> tuple[dict[str, Column], dict[str, Column]]:
    """Values that several rules use: from the fields, and then from each other."""
    bare, method = _n("frequencyBare_frequency"), _n("frequencyWithMethod_frequency")
    bare_top = F.coalesce(_n("frequencyBare_frequencyMax"), bare)
    method_top = F.coalesce(_n("frequencyWithMethod_frequencyMax"), method)
    bare_unit, method_unit = _w("frequencyBare_period_unit"), _w("frequencyWithMethod_period_unit")
    period, period_unit = _n("periodElement_period"), _w("periodElement_period_units")
    implied = _n("periodElement_frequency")
    unit = F.coalesce(bare_unit, method_unit, period_unit)
    length = F.when(bare_unit.isNotNull() | method_unit.isNotNull(), F.lit(1.0)).otherwise(_some(period))
    when = F.col("_when")
    first = {
        "_when": F.coalesce(_w("whenBare_when"), _w("whenWithMethod_when")),
        "_top": F.coalesce(bare_top, method_top, implied),
        "_top_unit": F.when(bare_top.isNotNull(), bare_unit)
        .when(method_top.isNotNull(), method_unit)
        .when(implied.isNotNull(), period_unit),
        "_freq": F.coalesce(bare, method, implied),
        "_freq_unit": F.when(bare.isNotNull(), bare_unit)
        .when(method.isNotNull(), method_unit)
        .when(implied.isNotNull(), period_unit),
        "_period_days": F.when(unit.isNotNull(), _days(length, unit)),
        "_period": F.coalesce(period, F.lit(1.0)),
    }
    second = {
        "_daily": F.coalesce(when.rlike(_ONCE_A_DAY), F.lit(False)),
        "_several": F.coalesce(when.rlike(_SEVERAL_A_DAY), F.lit(False)),
        "_when_plural": F.coalesce(when.rlike(_PLURAL), F.lit(False)),
    }
    return first, second


def _unit_disagrees(amount: Column, unit: Column) -> Column:
    """ "1 tablets" or "3 tablet"; "tablet(s)" fits every amount."""
    return ((amount == 1) & unit.isin(*vocab.PLURAL)) | ((amount > 1) & unit.isin(*vocab.SINGULAR))


def _metric_range() -> Column:
    low, high = _n("milligramMax_value"), _n("milligramMax_valueMax")
    low_unit, high_unit = _w("milligramMax_low_unit"), _w("milligramMax_milligram_units")
    same = low_unit.isNull() | (low_unit == high_unit)
    family = (low_unit.isin(*vocab.MASS) & high_unit.isin(*vocab.MASS)) | (
        low_unit.isin(*vocab.VOLUME) & high_unit.isin(*vocab.VOLUME)
    )
    factor = vocab.METRIC_FACTOR
    inverted = low * lookup(factor, low_unit) > high * lookup(factor, high_unit)
    known = low.isNotNull() & high.isNotNull() & high_unit.isNotNull()
    return known & F.when(same, low > high).otherwise(~family | inverted)


def _timing_cycle() -> Column:
    """Days between two doses as told by the weekday, timing or clock time."""
    return (
        F.when(_w("dayOfWeek_value").isNotNull(), 7.0)
        .when(F.col("_daily"), 1.0)
        .when(_w("timeOfDay_value").isNotNull(), 1.0)
    )


def _interval_differs() -> Column:
    """Period divided by frequency is not the timing cycle; counts have own rules."""
    count, clock = _n("count_count"), _w("timeOfDay_value").isNotNull()
    counted = count.isNotNull() & F.col("_top").isNull()
    once = clock | (F.col("_daily") & ~F.col("_when_plural"))
    count_fails = (once & (count > 1)) | (F.col("_several") & (count <= 1))
    known = F.col("_top").isNotNull() & F.col("_top_unit").isNotNull()
    days = _days(F.col("_period"), F.col("_top_unit"))
    # zero times a day has no interval and fails as well
    differs = (F.col("_top") == 0) | (F.try_divide(days, F.col("_top")) != _timing_cycle())
    return F.when(counted, count_fails).otherwise(known & differs)


def _single_time_without_frequency() -> Column:
    stated = (
        _w("frequencyBare_frequency").isNotNull()
        | _w("frequencyWithMethod_frequency").isNotNull()
        | _w("periodElement_period_units").isNotNull()
    )
    weekday = _w("dayOfWeek_value")
    single_day = weekday.isNotNull() & ~weekday.rlike(_PLURAL)
    single_when = F.col("_daily") & ~F.col("_when_plural")
    return ~stated & (single_day | single_when | _w("timeOfDay_value").isNotNull())


def _course_days() -> Column:
    """Length of the course; the upper end counts for a range."""
    amount = F.coalesce(F.nullif(_n("boundsDuration_high"), F.lit(0.0)), _n("boundsDuration_value"))
    unit = F.coalesce(_w("boundsDuration_high_unit"), _w("boundsDuration_unit"))
    return F.when(unit.isNotNull(), _days(amount, unit))


def _few_doses_several_times() -> Column:
    days = _days(F.col("_period"), F.col("_freq_unit"))
    a_day = F.try_divide(F.col("_freq"), days)
    return F.col("_several") & F.col("_freq_unit").isNotNull() & (days != 0) & (a_day <= 1)


def _long_duration_at_a_time() -> Column:
    hours = F.greatest(
        _days(_n("durationValue_value"), _w("durationValue_period_units")) * 24,
        _days(_n("durationMax_value"), _w("durationMax_period_units")) * 24,
    )
    return (hours > 1) & (_w("timeOfDay_value").isNotNull() | F.col("_daily"))


def _implied_without_single_dose() -> Column:
    """An implied "once" is only safe for a dose of exactly one."""
    applies = (
        _w("periodElement_period_units").isNotNull()
        & _n("frequencyBare_frequency").isNull()
        & _n("frequencyWithMethod_frequency").isNull()
    )
    dose = F.coalesce(_n("doseQuantity_quantity"), _n("dose_QuantityValueOnly_value"))
    return applies & (dose.isNull() | (dose != 1))


def _each_day_other_period() -> Column:
    captured = F.coalesce(_w("whenBare_captured"), _w("whenWithMethod_captured"))
    return captured.rlike(_EACH_DAILY) & (_w("periodElement_period_units") != "day")


def _over_a_year() -> Column:
    checks = [
        ("periodElement_period", "periodElement_period_units"),
        ("periodElement_periodMax", "periodElement_period_units"),
        ("durationValue_value", "durationValue_period_units"),
        ("durationMax_value", "durationMax_period_units"),
        ("boundsDuration_value", "boundsDuration_unit"),
        ("boundsDuration_high", "boundsDuration_high_unit"),
    ]
    result = F.lit(False)
    for amount, unit in checks:
        fails = (_n(amount) > 365) & _w(unit).isin("day", "days")
        result = result | F.coalesce(fails, F.lit(False))
    return result


def _many_a_day(name: str) -> Column:
    return (_n(f"{name}_frequency") > 12) & _w(f"{name}_period_unit").isin("day", "days")


def _either(*tests: Column) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | F.coalesce(test, F.lit(False))
    return result


@cache
def rules() -> dict[str, Column]:
    """Code -> condition under which the rule fails, in reporting order."""
    quantity, unit = _n("doseQuantity_quantity"), _w("doseQuantity_units")
    high, high_unit = _n("doseRange_high"), _w("doseRange_units")
    most = _n("maxDosePerPeriod_num_value")
    fortnight = (_w("periodElement_period_units") == "fortnight") & (_n("periodElement_period") != 1)
    event, course = _w("event_value").isNotNull(), _n("boundsDuration_value").isNotNull()
    unit_dose = vocab.UNIT_DOSE
    return {
        "CC1": fortnight,
        "CC2": _either(_unit_disagrees(quantity, unit), _unit_disagrees(high, high_unit)),
        "CC3": _metric_range(),
        "CC4": _either(most < quantity, most < high),
        "CC5": _interval_differs(),
        "CC6": _single_time_without_frequency(),
        "CC7": F.col("_period_days") > _course_days(),
        "CC8": event & (F.col("_period_days") > 1),
        "CC9": course & (event | _n("count_count").isNotNull()),
        "CC10": _few_doses_several_times(),
        "CC11": _long_duration_at_a_time(),
        "CC12": _implied_without_single_dose(),
        "CC13": _each_day_other_period(),
        "VC1": _over_a_year(),
        "VC2": _either((quantity > 10) & unit.isin(*unit_dose), (high > 10) & high_unit.isin(*unit_dose)),
        "VC3": _either(_many_a_day("frequencyBare"), _many_a_day("frequencyWithMethod")),
    }


@cache
def _codes() -> Column:
    return F.concat_ws(", ", *[F.when(fails, F.lit(code)) for code, fails in rules().items()])


def check_columns(df: DataFrame) -> DataFrame:
    """Add ``cross_column_fail``: all failing codes, NULL where none fails."""
    have = set(df.columns)
    df = with_missing(df, READS)
    first, second = _facts()
    df = df.withColumns(first).withColumns(second)
    failed = F.concat(F.lit("cross_column_fail: "), F.nullif(_codes(), F.lit("")))
    df = df.withColumns({"cross_column_fail": failed})
    df = df.drop(*first, *second, *[c for c in READS if c not in have])
    return fence(df, "cross_column_fail")


def apply_cross_column_rules(df: DataFrame) -> DataFrame:
    """Exclude rows that fail; an earlier reason in ``exclude`` is kept."""
    df = check_columns(with_missing(df, ["exclude"]))
    df = with_missing(df, ["mapped"], "boolean")
    failed = F.col("cross_column_fail")
    mapped = F.when(failed.isNotNull(), F.lit(False)).otherwise(F.col("mapped"))
    return df.withColumns({"exclude": F.coalesce("exclude", failed), "mapped": mapped})
