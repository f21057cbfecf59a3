"""

All queries run over a corpus that is derived from the whole ``lineitem`` table (one
instruction per line item) or over ``documents``.  The oracles take their expected values
from the columns that the corpus was generated from; they never parse the text.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from importlib import import_module
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posofold import vocab
from posofold.functions.lemma import base_forms
from posofold.functions.stream import encode, surface_forms, tokens_of
from posofold.operators import corpus, infer, reports
from posofold.operators import normalise as norm
from posofold.operators.assess import assess, extract
from posofold.operators.elements import BY_KEY, ELEMENTS, KEYS, REGEX_ELEMENTS
from posofold.operators.enrich import refine
from posofold.operators.extract import extract_element, extract_elements
from posofold.operators.fhir import PARTS
from posofold.operators.grammar import check_grammar
from posofold.operators.regex_elements import read_leading
from posofold.operators.spans import spans
from posofold.plans import jobs
from posofold.sources import readings, tables, templates
from posofold.sources.templates import case_sql, fill, literal, slots_sql
from posofold.sources.vocabulary import normalisation_rules, term_rows

# the corpus operators are optional; a fault inside them is no absence
_OPTIONAL = ("corpus_pipeline", "posofold.llm")
corpus_queries = import_module("posofold.llm.queries") if all(map(find_spec, _OPTIONAL)) else None

Query = Callable[[SparkSession, str], DataFrame]
ROW = ["dosage", "dosage_count"]
ARRAYS = ("doseQuantity_quantity", "periodElement_period")  # fields shown in array form
BATCH_CUT = 5  # cut-off that splits the generated corpus as 10000 splits a real one


# ------------------------------------------------------------------ Spark side


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.configure(spark)
    return corpus.count_instructions(templates.instructions(spark, sf_dir), ordered=False)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.configure(spark)
    return corpus.count_instructions(templates.wide_instructions(spark, sf_dir), ordered=False)


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm.normalise(_counted(spark, sf_dir)).withColumn("dosage_elements", F.col("dosage_lower"))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token elements before anything is inferred from them."""
    return extract_elements(read_leading(_plain(spark, sf_dir)))


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_counted(spark, sf_dir))


def _assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(_counted(spark, sf_dir))


def _datasets(spark: SparkSession) -> jobs.Datasets:
    """Names of the datasets of a run, in the shared folder."""
    jobs.configure(spark)
    folder = tables.scratch(spark)
    return jobs.Datasets(*[f"{folder}{n}/" for n in "records curated united lookup refined filtered reports".split()])


def _run(spark: SparkSession, sf_dir: str, *steps: Callable) -> jobs.Datasets:
    """Datasets of a run of jobs over the whole generated corpus, in the shared folder."""
    at = _datasets(spark)
    tables.write(templates.instructions(spark, sf_dir), at.records)
    tables.write(spark.createDataFrame([], "dosage string"), at.curated)
    jobs.run_prepare(spark, at)
    for step in steps:
        step(spark, at)
    return at


def _written_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _run(spark, sf_dir, lambda s, at: jobs.run_model(s, at, BATCH_CUT))
    return tables.read(spark, at.lookup)


def _written(df: DataFrame) -> DataFrame:
    """The frame as a dataset, as the jobs hand it over: what follows reads it several times."""
    path = tables.scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(_assessed(spark, sf_dir))


def _lookup(spark: SparkSession, sf_dir: str, min_count: int | None = None) -> DataFrame:
    united = _counted(spark, sf_dir).withColumn("is_test", F.lit(False))
    return jobs.model(united, min_count, ordered=False)


def _codes(df: DataFrame, column: str) -> DataFrame:
    """One row per failing rule code."""
    code = F.explode(F.split(F.regexp_replace(column, r"^\w+: ", ""), ", "))
    return df.where(F.col(column).isNotNull()).select(*ROW, code.alias("code"))


def _element(key: str) -> Query:
    names = ["clean", "captured", "pattern", *BY_KEY[key].fields]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = extract_element(read_leading(_plain(spark, sf_dir)), key).where(F.col(f"{key}_clean").isNotNull())
        return df.select(*ROW, *[F.col(f"{key}_{n}").alias(f"{key}_{n}") for n in names])

    return run


def _phrase(key: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        extra = ["route_adverbial"] if key == "route" else []
        return _extracted(spark, sf_dir).where(F.col(f"{key}_clean") != "").select(*ROW, f"{key}_clean", *extra)

    return run


def _step(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        low = norm.lower_and_squeeze(F.col("dosage"))
        df = _counted(spark, sf_dir).select(*ROW, low.alias("text"))
        return df.select(*ROW, norm.STEPS[name](F.col("text")).alias("text"))

    return run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.configure(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


REFINED = {
    "R1": ["doseQuantity_value", "doseQuantity_unit"],
    "R2": ["doseRange_low", "doseRange_high", "doseRange_lowunit", "doseRange_highunit"],
    "R4_R5_R6": [
        "milligram_value", "milligram_valueMax", "milligram_units", "method_verb", "frequency_value",
        "frequency_valueMax", "frequency_periodUnit", "period_value", "period_units", "duration_value",
        "duration_valueMax", "duration_units", "when_value", "when_offset", "when_periodUnit",
        "boundsPeriod_start", "boundsPeriod_end", "doseXMilli_value", "rateRange_unit", "rateRatio_periodUnit",
    ],
    "R3_R7": [
        "dose_unit_code", "dose_unit_display", "dose_unit_system", "maxDosePerPeriod_num_unit_code",
        "maxDosePerAdministration_unit_display", "rateQuantity_unit_system",
    ],
    "R8_R9": ["method_snomed_code", "method_snomed_display", "route_snomed_code", "route_snomed_display"],
    "R10_R11_R12": [
        "frequency_periodUnit_ucum", "period_units_ucum", "boundsDuration_unit_ucum", "dayOfWeek_fhir", "when_fhir",
    ],
}


def _refined_columns(names: list[str]) -> Query:
    return lambda spark, sf_dir: _refined(spark, sf_dir).select(*ROW, *names)


def _p3(spark, sf_dir):
    return corpus.regroup(norm.normalise(_counted(spark, sf_dir))).select(
        "dosage_lower", "dosage_count", "variants"
    )


def _p4(spark, sf_dir):
    grouped = corpus.regroup(norm.normalise(_counted(spark, sf_dir))).drop("variants")
    return corpus.frequent_keys(grouped, BATCH_CUT)


def _p8_batch(spark, sf_dir):
    """A lookup of half of the spellings, extended to all of them."""
    normalised = _written(norm.normalise(_counted(spark, sf_dir).withColumn("is_test", F.lit(False))))
    half = normalised.where(F.crc32("dosage") % 2 == 0)
    columns = [*ROW, "dosage_lower", "buckets", "exclude", "mapped"]
    lookup = _written(jobs.model_normalised(half, BATCH_CUT, ordered=False).select(*columns))
    return lookup.union(jobs.batch_normalised(normalised, lookup, BATCH_CUT).select(*columns))


def _t1(spark, sf_dir):
    df = infer.infer_timing(_tokens(spark, sf_dir))
    daily = F.col("periodElement_clean").isNotNull() & F.col("periodElement_captured").isNull()
    columns = ["clean", "period", "period_units", "frequency"]
    return df.where(daily).select(*ROW, *[f"periodElement_{c}" for c in columns], "whenBare_clean", "whenBare_when")


def _t6(spark, sf_dir):
    excluded = _tokens(spark, sf_dir).withColumn("exclude", F.lit("general_fail: review"))
    rescued = infer.rescue_offsets(excluded).where(F.col("extras_whenoffset").isNotNull())
    return rescued.select(*ROW, "extras_whenoffset", "whenBare_clean")


def _grammar(spark, sf_dir):
    tagged = _extracted(spark, sf_dir).select(*ROW, F.trim("dosage_elements").alias("dosage_elements"))
    return check_grammar(tagged).select(*ROW, "dosage_elements", "grammar_fail")


def _numeric(spark, sf_dir):
    df = _assessed(spark, sf_dir).where(F.col("exclude").startswith("numeric_fail"))
    return df.select(*ROW, F.col("exclude").alias("numeric_fail"))


def _spans(spark, sf_dir, chosen: bool, *columns: str):
    """One row for each hit of a pattern."""
    found = spans(read_leading(_plain(spark, sf_dir))).select(*ROW, F.explode("spans").alias("s"))
    return found.where(F.col("s.chosen") == chosen).select(*ROW, *[F.col(f"s.{c}").alias(c) for c in columns])


def _readings(spark, sf_dir):
    jobs.configure(spark)
    return corpus.count_instructions(readings.instructions(spark, sf_dir), ordered=False)


def _reading_hits(spark, sf_dir):
    """Each element of each instruction of the second corpus, with its pattern and fields."""
    df = norm.normalise(_readings(spark, sf_dir)).withColumn("dosage_elements", F.col("dosage_lower"))
    df = extract_elements(read_leading(df))
    hits = []
    for e in ELEMENTS:
        named = [F.when(F.col(f"{e.key}_{f}") != "", F.concat(F.lit(f"{f}="), F.col(f"{e.key}_{f}"))) for f in e.fields]
        fields = F.concat_ws(";", *named)
        hit = F.struct(F.lit(e.key).alias("element"), F.col(f"{e.key}_pattern").alias("pattern"), F.col(f"{e.key}_clean").alias("clean"), fields.alias("fields"))
        hits.append(F.when(F.col(f"{e.key}_pattern").isNotNull(), hit))
    return df.select(*ROW, F.explode(F.array_compact(F.array(*hits))).alias("h")).select(*ROW, "h.*")


def _reading_timing(spark, sf_dir):
    """Numbers of the FHIR timing, where one of those that are rare is set."""
    repeat = {
        "period": "period", "periodMax": "periodMax", "unit": "periodUnit", "count": "count", "countMax": "countMax",
        "low": "boundsRange.low.value", "high": "boundsRange.high.value",
    }
    df = refine(assess(_readings(spark, sf_dir))).where(F.col("mapped"))
    found = df.select(*ROW, *[F.get_json_object("fhir_json", f"$.timing.repeat.{path}").alias(name) for name, path in repeat.items()])
    rare = F.coalesce("periodMax", "count", "countMax", "low", "high", F.when(F.col("dosage").contains(" every "), F.col("period")))
    return found.where(rare.isNotNull())


def _base_forms(spark, sf_dir):
    """How often each base form occurs in the normalised instructions, by spelling."""
    words = F.filter(F.split("dosage_lower", "[^a-z]+"), lambda w: w != "")
    rows = norm.normalise(_counted(spark, sf_dir)).select("dosage_count", words.alias("words"))
    rows = rows.withColumn("bases", base_forms(F.col("words"))).select("dosage_count", F.explode(F.arrays_zip("words", "bases")).alias("w"))
    rows = rows.select("dosage_count", F.col("w.words").alias("word"), F.col("w.bases").alias("base"))
    return rows.groupBy("word", "base").agg(F.sum("dosage_count").alias("total_count"))


def _words(kind: str, name: str) -> Query:
    """How the operators read each word of a kind."""

    def run(spark, sf_dir):
        jobs.configure(spark)
        df = extract(corpus.count_instructions(readings.word_instructions(spark, sf_dir, kind), ordered=False))
        read = F.regexp_replace("dosage_lower", "^1 tablet ", "") if name == "read_as" else F.col(name)
        return df.select(*ROW, read.alias(name))

    return run


WORDS = {
    "G9_routes": ("route", "route_clean"),
    "N3_latin": ("latin", "read_as"),
    "G8_purposes": ("purpose", "asNeededCodeableConcept_clean"),
}


def _reading_failures(spark, sf_dir):
    return assess(_readings(spark, sf_dir)).where(F.col("exclude").startswith("numeric_fail")).select(*ROW, "exclude")


def _p8_counts(spark, sf_dir):
    """A lookup of the even orders, renewed by a batch over all of them."""
    at = _datasets(spark)
    tables.write(spark.createDataFrame([], "dosage string"), at.curated)
    for where, job in (("l_orderkey % 2 = 0", jobs.run_model), ("true", jobs.run_batch)):
        tables.write(templates.instructions(spark, sf_dir, where), at.records)
        jobs.run_prepare(spark, at)
        job(spark, at, BATCH_CUT)
    return tables.read(spark, at.lookup).select(*ROW, "dosage_lower", "buckets", "exclude", "cross_column_fail", "mapped")


def _src5_batch(spark, sf_dir):
    """A lookup made with a wrong word in the site's vocabulary, and a batch after its correction."""
    at = replace(_datasets(spark), vocabulary=f"{tables.scratch(spark)}words/")
    tables.write(spark.createDataFrame([], "dosage string"), at.curated)
    tables.write(templates.instructions(spark, sf_dir), at.records)
    words = "term string, meaning string"
    tables.write(spark.createDataFrame([("capsules", "capsule"), ("tablets", "pills")], words), at.vocabulary)
    jobs.run_prepare(spark, at)
    jobs.run_model(spark, at, BATCH_CUT)
    tables.write(spark.createDataFrame([], words), at.vocabulary)
    jobs.run_batch(spark, at, BATCH_CUT)
    return tables.read(spark, at.lookup).select(*ROW, "dosage_lower", "buckets", "exclude", "cross_column_fail", "mapped")


def _snk(spark, sf_dir):
    """The lookup read again, refined and filtered, both written; the filtered rows read again."""
    at = _run(spark, sf_dir, lambda s, at: jobs.run_model(s, at, None), lambda s, at: jobs.run_refine(s, at, BATCH_CUT))
    return tables.read(spark, at.filtered).select(*ROW, "dosage_lower", "buckets")


def _snk3(spark, sf_dir):
    """The eight reports as written: rows of each."""
    steps = (lambda s, at: jobs.run_model(s, at, None), lambda s, at: jobs.run_refine(s, at, None), jobs.run_reports)
    at = _run(spark, sf_dir, *steps)
    names = ("element_orders_mapped", "pattern_usage", "preprocessing_report", "random_sample", "captured_clean_summary")
    counted = [
        tables.read(spark, at.reports + n).agg(F.lit(n).alias("report"), F.count(F.lit(1)).alias("n")).select("report", "n") for n in names
    ]
    return reduce(DataFrame.union, counted)


def _snk4(spark, sf_dir):
    """Facts of the written lookup about its own making."""
    df = _written_lookup(spark, sf_dir)
    made = F.col("timestamp").isNotNull() & (F.col("timestamp") == F.col("_snapshot_ts")) & (F.col("timestamp") <= F.current_timestamp())
    return df.select(*ROW, "space", made.alias("stamped"))


def _fhir_parts(spark, sf_dir):
    df = _refined(spark, sf_dir).where(F.col("fhir_json").isNotNull())
    parts = [F.get_json_object("fhir_json_no_text", f"$.{p}").alias(p) for p in PARTS]
    return df.select(*ROW, *parts)


def _a8(spark, sf_dir):
    return reports.normalisation_usage(_counted(spark, sf_dir).select("dosage"))


def entry(spark: SparkSession) -> DataFrame:
    """The most frequent structured instructions of the corpus."""
    sf_dir = os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001")
    lookup = _lookup(spark, sf_dir)
    return (
        lookup.where(F.col("mapped"))
        .groupBy("buckets", "dosage_elements")
        .agg(F.sum("dosage_count").alias("total_count"), F.min("dosage").alias("example_dosage"))
        .orderBy(F.desc("total_count"), "buckets")
    )


def queries() -> dict[str, Query]:
    mapped_text = ["fhir_json"]
    out: dict[str, Query] = {
        "SRC1_P1": lambda s, d: corpus.count_instructions(templates.instructions(jobs.configure(s), d)),
        "SRC2_P2": lambda s, d: corpus.unite(_counted(s, d), _wide(s, d)),
        "P3": _p3,
        "P4": _p4,
        "P5": lambda s, d: _lookup(s, d, BATCH_CUT).select(
            *ROW, "dosage_lower", "buckets", "exclude", "cross_column_fail", "mapped"
        ),
        "P9": lambda s, d: _written_lookup(s, d).select(
            *ROW, "is_test", "dosage_lower", "buckets", "exclude", "cross_column_fail", "mapped"
        ),
        "R13": lambda s, d: jobs.published(_assessed(s, d)).select(
            *ROW, *[F.concat(F.lit("["), F.array_join(c, ","), F.lit("]")).alias(c) for c in ARRAYS]
        ),
        "P6": lambda s, d: corpus.curated_first(corpus.unite(_counted(s, d), _wide(s, d))),
        "P7": lambda s, d: jobs.filtered(_written(jobs.refined(_lookup(s, d))), BATCH_CUT).select(*ROW, "dosage_lower", "buckets"),
        "P8": lambda s, d: corpus.not_yet_assessed(
            _counted(s, d), _counted(s, d).where(F.col("dosage_count") >= BATCH_CUT)
        ),
        "P8_batch": _p8_batch,
        "P8_counts": _p8_counts,
        "SRC5_batch": _src5_batch,
        "E_readings": _reading_hits,
        "F3_timing": _reading_timing,
        "NV1_negative": _reading_failures,
        "SRC4_SNK1_SNK2": _snk,
        "SNK3": _snk3,
        "SNK4": _snk4,
        "N1": lambda s, d: _documents(s, d).select("doc_id", F.lower("text").alias("text")),
        "N2": lambda s, d: _documents(s, d).select("doc_id", norm.lower_and_squeeze(F.col("text")).alias("text")),
        "N3": _step("latin"),
        "N4": lambda s, d: norm.screen(
            _counted(s, d).select(*ROW, norm.lower_and_squeeze(F.col("dosage")).alias("text")), "text"
        ),
        "N5": _step("words_to_digits"),
        "N6": _step("units_of_measure"),
        "N7": _step("isolated_terms"),
        "N8": _step("date_separators"),
        "N9": _step("number_ranges"),
        "N10": lambda s, d: _counted(s, d).select(*ROW, norm.tidy(F.col("dosage")).alias("text")),
        "N11": lambda s, d: norm.replace_dictionary(
            _counted(s, d).withColumn("text", F.col("dosage")), "text",
            {"tab": ["tablet", "tablets"], "cap": ["capsule"]}, swap=True,
        ),
        "N1_N10": lambda s, d: norm.normalise(_counted(s, d)).select(*ROW, "dosage_lower", "exclude"),
        "X1": lambda s, d: norm.normalise(_counted(s, d)).select(
            *ROW, F.array_join(tokens_of(encode(F.col("dosage_lower"))), "").alias("glued")
        ),
        "X4_X5_X12": lambda s, d: _extracted(s, d).select(*ROW, "dosage_elements"),
        "X2": _base_forms,
        "X4_spans": lambda s, d: _spans(s, d, True, "element", "pattern", "captured"),
        "X5_rejected": lambda s, d: _spans(s, d, False, "element", "pattern", "start", "size", "captured", "reason", "by"),
        "X6": lambda s, d: _tokens(s, d)
        .where(F.col("doseQuantity_units").isin(*vocab.VERB_OR_UNIT))
        .select(*ROW, "doseQuantity_clean", "methodDirect_clean"),
        "X10": lambda s, d: _tokens(s, d)
        .where(F.col("doseQuantity_captured").contains("(s)"))
        .select(*ROW, "doseQuantity_units", "doseQuantity_clean"),
        "X11": lambda s, d: _extracted(s, d)
        .where(F.col("dosage_elements").contains("Dashed*"))
        .select(*ROW, "dosage_elements"),
        "T1_T2": _t1,
        "T3_T4": lambda s, d: infer.infer_timing(_tokens(s, d))
        .where(F.col("whenBare_clean").isNotNull())
        .select(*ROW, "whenBare_clean", "whenBare_when"),
        "T6": _t6,
        "T7": lambda s, d: _extracted(s, d).select(*ROW, "buckets"),
        "T8": lambda s, d: _assessed(s, d).select(*ROW, "dosage_lower", "dosage_elements", "buckets", "exclude", "mapped"),
        "T8_wide": lambda s, d: assess(_wide(s, d)).select(*ROW, "dosage_elements", "buckets", "exclude", "mapped"),
        "V0_V1": _grammar,
        "S1_S8_O1_O10": lambda s, d: _codes(
            _assessed(s, d).where(F.col("exclude").startswith("grammar_fail")), "exclude"
        ),
        "NV1_NV10": _numeric,
        "V2_V3_V4": lambda s, d: _assessed(s, d).select(*ROW, "dosage_spare", "exclude", "mapped"),
        "CC1_CC13_VC1_VC3": lambda s, d: _codes(_assessed(s, d), "cross_column_fail"),
        "R14": _refined,
        "F1_F14": _fhir_parts,
        "F15": lambda s, d: _refined(s, d).where(F.col("mapped")).select(*ROW, *mapped_text),
        "F16": lambda s, d: _refined(s, d).where(F.col("mapped")).select(*ROW, "fhir_json_no_text"),
        "A1": lambda s, d: reports.captured_summary(_assessed(s, d)),
        "A2": lambda s, d: reports.random_sample(_refined(s, d)).select(*ROW, "buckets"),
        "A3": lambda s, d: reports.sample_by_frequency(_written(_refined(s, d))).select(*ROW, "frequency_band", "buckets"),
        "A4": lambda s, d: reports.sample_by_element(_written(_refined(s, d))).select(*ROW, "sampled_element"),
        "A5": lambda s, d: reports.tag_orders(_assessed(s, d)),
        "A6": lambda s, d: reports.pattern_usage(_tokens(s, d)).select("element", "pattern", "hits", "total_count"),
        "A7": lambda s, d: reports.vocabulary_usage(norm.normalise(_counted(s, d))),
        "A8": _a8,
    }
    for i, element in enumerate(ELEMENTS, start=1):
        out[f"E{i}"] = _element(element.key)
    for i, key in enumerate(REGEX_ELEMENTS, start=1):
        out[f"G{i}"] = _phrase(key)
    for name, columns in REFINED.items():
        out[name] = _refined_columns(columns)
    for name, (kind, column) in WORDS.items():
        out[name] = _words(kind, column)
    if corpus_queries:
        out.update(corpus_queries.queries())
    return out


# ------------------------------------------------------------------ oracle side


def _truth(fields: dict[str, str], where: str = "", select: str = "*") -> str:
    """Distinct instructions with count and expected values, as SQL."""
    columns = ", ".join(f"{sql} AS {name}" for name, sql in fields.items())
    columns = f", {columns}" if columns else ""
    return (
        f"SELECT {select} FROM (SELECT dosage, count(*) AS dosage_count{''.join(f', {n}' for n in fields)} "
        f"FROM (SELECT {case_sql('text')} AS dosage{columns} FROM ({slots_sql()})) GROUP BY ALL) {where}"
    )


def _expected(*names: str) -> dict[str, str]:
    return {n: case_sql(n) for n in names}


def _final(name: str) -> str:
    return f"coalesce({case_sql('final_' + name)}, {case_sql(name)})"


_EXCLUDE, _SPARE = case_sql("exclude"), case_sql("spare", "''")
_MAPPED = f"({_EXCLUDE} IS NULL AND {_SPARE} = '')"


def _re2(pattern: str) -> str:
    """The pattern without look-ahead, which the other engine does not have."""
    return pattern.replace(r"\b(?!/)", r"(?:[^/\w]|$)")


def _replace_sql(text: str, terms) -> str:
    for pattern, replacement in terms:
        replacement = replacement.replace("$", "\\")
        if pattern.endswith(r"\.?(?!\w)"):  # dotted Latin: keep the character behind it
            pattern = pattern[: -len(r"(?!\w)")] + r"(\W|$)"
            replacement += "\\1"
        text = f"regexp_replace({text}, {literal(pattern)}, {literal(replacement)}, 'g')"
    return f"regexp_replace({text}, '\\s{{2,}}', ' ', 'g')"


_SQUEEZED = "regexp_replace(trim(lower({})), '[ \\t]+', ' ', 'g')"


def _step_sql(terms) -> str:
    text = _replace_sql(_SQUEEZED.format("dosage"), terms)
    return _truth({}, select=f"dosage, dosage_count, {text} AS text")


def _tidy_sql(text: str) -> str:
    for pattern, replacement in ((r"\.+$", ""), (r"^\.\s*", ""), (r"\.\s*\.", ".")):
        text = f"regexp_replace({text}, {literal(pattern)}, {literal(replacement)}, 'g')"
    return text


def _values(rows, names: str) -> str:
    def one(v):
        return "NULL" if v is None else literal(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {names}"


def _joined(parts: list[str]) -> str:
    """First expected value that is stated."""
    return f"coalesce({', '.join(case_sql(p) for p in parts)})"


_DOSE_UNIT = (
    f"CASE WHEN {case_sql('doseQuantity_quantity')} IS NOT NULL THEN {case_sql('doseQuantity_units')} "
    f"WHEN {case_sql('dose_QuantityValueOnly_value')} IS NOT NULL THEN NULL "
    f"ELSE {case_sql('milligramValue_milligram_units')} END"
)
_RANGE_UNIT = _joined(["doseRange_units", "milligramMax_milligram_units"])
_REFINED_SQL = {
    "doseQuantity_value": _joined(["doseQuantity_quantity", "dose_QuantityValueOnly_value", "milligramValue_value"]),
    "doseQuantity_unit": _DOSE_UNIT,
    "doseRange_low": _joined(["doseRange_low", "dose_QuantityValueAndMaxOnly_value", "milligramMax_value"]),
    "doseRange_high": _joined(["doseRange_high", "dose_QuantityValueAndMaxOnly_valueMax", "milligramMax_valueMax"]),
    "doseRange_lowunit": _RANGE_UNIT,
    "doseRange_highunit": _RANGE_UNIT,
    "milligram_value": _joined(["milligramValue_value", "milligramMax_value"]),
    "milligram_valueMax": case_sql("milligramMax_valueMax"),
    "milligram_units": _joined(["milligramValue_milligram_units", "milligramMax_milligram_units"]),
    "method_verb": _joined(["methodDirect_verb", "methodPassive_verb"]),
    "frequency_value": _joined(
        ["frequencyBare_frequency", "frequencyWithMethod_frequency", "final_periodElement_frequency",
         "periodElement_frequency"]
    ),
    "frequency_valueMax": _joined(["frequencyBare_frequencyMax", "frequencyWithMethod_frequencyMax"]),
    "frequency_periodUnit": _joined(["frequencyBare_period_unit", "frequencyWithMethod_period_unit"]),
    "period_value": _final("periodElement_period"),
    "period_units": _final("periodElement_period_units"),
    "duration_value": case_sql("durationValue_value"),
    "duration_valueMax": case_sql("durationMax_value"),
    "duration_units": _joined(["durationValue_period_units", "durationMax_period_units"]),
    "when_value": f"coalesce({_final('whenBare_when')}, {_final('whenWithMethod_when')})",
    "when_offset": _joined(["whenBare_offset", "whenWithMethod_offset"]),
    "when_periodUnit": _joined(["whenBare_period_unit", "whenWithMethod_period_unit"]),
    "boundsPeriod_start": _joined(["boundsPeriod_start", "boundsAPeriodStartEnd_start"]),
    "boundsPeriod_end": _joined(["boundsPeriod_end", "boundsAPeriodStartEnd_end"]),
    "doseXMilli_value": case_sql("doseXMilliValueOnly_value"),
    "rateRange_unit": case_sql("rateRange_special_unit"),
    "rateRatio_periodUnit": case_sql("rateRatio_period_unit"),
}
_SNOMED, _UCUM = "http://snomed.info/sct", "http://unitsofmeasure.org"
_UNIT_ROWS = (
    [(w, d, _SNOMED, c) for one, many, c, d, _ in vocab.DOSE_FORMS if c for w in (one, many)]
    + [(w, u, _UCUM, u) for w, u in vocab.METRIC_UCUM.items()]
)


def _coded_units() -> str:
    """Unit codes by joins with a table of units; a 5 ml spoon has a code of its own."""
    fields = {
        "u": f"coalesce({_DOSE_UNIT}, {_RANGE_UNIT})",
        "spoon": f"coalesce({case_sql('doseQuantity_spoonsize')}, {case_sql('doseRange_spoonsize')})",
        "p": case_sql("maxDosePerPeriod_num_unit"),
        "a": case_sql("maxDosePerAdministration_unit"),
        "q": case_sql("rateQuantity_special_unit"),
    }
    units = [_values(_UNIT_ROWS, f"{t}(unit, display, system, code)") for t in ("du", "pu", "au", "qu")]
    sized = "(u IN ('spoonful', 'spoonfuls') AND spoon = '5')"
    return (
        "SELECT dosage, dosage_count, "
        f"CASE WHEN {sized} THEN '514941000000109' ELSE coalesce(du.code, u) END AS dose_unit_code, "
        f"CASE WHEN {sized} THEN '5ml spoonful' ELSE coalesce(du.display, u) END AS dose_unit_display, "
        f"CASE WHEN {sized} THEN '{_SNOMED}' WHEN u IS NULL THEN NULL ELSE coalesce(du.system, '{_UCUM}') END "
        "AS dose_unit_system, coalesce(pu.code, p) AS maxDosePerPeriod_num_unit_code, "
        "coalesce(au.display, a) AS maxDosePerAdministration_unit_display, "
        f"CASE WHEN q IS NULL THEN NULL ELSE coalesce(qu.system, '{_UCUM}') END AS rateQuantity_unit_system "
        f"FROM ({_truth(fields)}) g LEFT JOIN {units[0]} ON g.u = du.unit LEFT JOIN {units[1]} ON g.p = pu.unit "
        f"LEFT JOIN {units[2]} ON g.a = au.unit LEFT JOIN {units[3]} ON g.q = qu.unit"
    )


def _coded_methods() -> str:
    methods = [(v, c, d) for v, _, c, d in vocab.METHODS if c] + list(vocab.COMPOUND_METHODS)
    routes = [(r, c, d) for r, c, d, _ in vocab.ROUTES if c]
    fields = {"v": _REFINED_SQL["method_verb"], "r": case_sql("route_clean")}
    return (
        "SELECT dosage, dosage_count, m.code AS method_snomed_code, coalesce(m.display, v) AS method_snomed_display, "
        "w.code AS route_snomed_code, coalesce(w.display, r) AS route_snomed_display "
        f"FROM ({_truth(fields)}) g LEFT JOIN {_values(methods, 'm(verb, code, display)')} ON g.v = m.verb "
        f"LEFT JOIN {_values(routes, 'w(route, code, display)')} ON g.r = w.route"
    )


def _coded_periods() -> str:
    ucum = list(vocab.PERIOD_UCUM.items())
    fields = {
        "f": _REFINED_SQL["frequency_periodUnit"], "p": _REFINED_SQL["period_units"],
        "b": case_sql("boundsDuration_unit"), "d": case_sql("dayOfWeek_value"), "w": _REFINED_SQL["when_value"],
    }
    tables = [_values(ucum, f"{t}(unit, code)") for t in ("fu", "pu", "bu")]
    when = (
        "CASE WHEN w LIKE '% food' THEN NULL WHEN w LIKE '%morning' THEN 'MORN' WHEN w LIKE '%night' THEN 'NIGHT' "
        "WHEN w LIKE '%bedtime' THEN 'HS' WHEN w LIKE '%waking' THEN 'WAKE' WHEN w = 'with meals' THEN 'C' END"
    )
    return (
        "SELECT dosage, dosage_count, fu.code AS frequency_periodUnit_ucum, pu.code AS period_units_ucum, "
        "bu.code AS boundsDuration_unit_ucum, CASE WHEN d = 'on monday' THEN 'mon' END AS dayOfWeek_fhir, "
        f"{when} AS when_fhir FROM ({_truth(fields)}) g LEFT JOIN {tables[0]} ON g.f = fu.unit "
        f"LEFT JOIN {tables[1]} ON g.p = pu.unit LEFT JOIN {tables[2]} ON g.b = bu.unit"
    )


def _exploded(column: str, where: str) -> str:
    codes = "unnest(string_split(regexp_replace(failed, '^\\w+: ', ''), ', ')) AS code"
    return _truth({"failed": case_sql(column)}, f"WHERE {where}", f"dosage, dosage_count, {codes}")


def _summary() -> str:
    """Captured and clean wording by element, from one branch per element."""
    branches = []
    for key in KEYS:
        fields = {
            "captured": case_sql(f"{key}_captured"), "clean": _final(f"{key}_clean"), "mapped": _MAPPED,
            "json": f"CASE WHEN {_MAPPED} THEN {_JSON} END",
        }
        branches.append(_truth(fields, "WHERE clean IS NOT NULL", f"'{key}' AS element, *"))
    return (
        "SELECT element, captured, clean, mapped, CAST(sum(dosage_count) AS BIGINT) AS frequency, "
        f"min(json) AS fhir_json_example FROM ({' UNION ALL '.join(branches)}) GROUP BY ALL"
    )


_JSON = (
    f"'{{\"text\":\"' || {case_sql('text')} || '\",' || substr({case_sql('fhir')}, 2)"
)


def _element_sample() -> str:
    columns = {
        "methodDirect": "method_verb", "rateRatio": "rateRatio_periodUnit", "rateRange": "rateRange_unit",
        "durationValue": "duration_value", "durationMax": "duration_valueMax",
        "frequencyWithMethod": "frequency_value", "periodElement": "period_value",
        "whenWithMethod": "when_value", "boundsPeriod": "boundsPeriod_start", "doseRange": "doseRange_low",
        "doseQuantity": "doseQuantity_value", "doseXMilliValueOnly": "doseXMilli_value",
        "milligramMax": "milligram_valueMax", "milligramValue": "milligram_value",
    }
    plain = {
        "rateQuantity": "rateQuantity_special_unit", "timeOfDay": "timeOfDay_value", "dayOfWeek": "dayOfWeek_value",
        "maxDosePerPeriod": "maxDosePerPeriod_num_value",
        "maxDosePerAdministration": "maxDosePerAdministration_value", "maxDosePerLifetime": "maxDosePerLifetime_value",
        "boundsDuration": "boundsDuration_value", "event": "event_value", "count": "count_count",
    }
    sources = {e: _REFINED_SQL[c] for e, c in columns.items()} | {e: case_sql(c) for e, c in plain.items()}
    branches = [
        _truth({"v": sql, "m": _MAPPED}, "WHERE m AND v IS NOT NULL", f"dosage, dosage_count, '{e}' AS sampled_element")
        for e, sql in sources.items()
    ]
    share = reports.SAMPLE // len(KEYS)
    return (
        "SELECT dosage, dosage_count, sampled_element FROM (SELECT *, row_number() OVER (PARTITION BY sampled_element "
        f"ORDER BY md5('42:' || dosage), dosage) AS rank FROM ({' UNION ALL '.join(branches)})) WHERE rank <= {share}"
    )


def _patterns_sql() -> str:
    names = [(e.key, p.name) for e in ELEMENTS for p in e.patterns]
    branches = [
        _truth({"pattern": case_sql(f"{k}_pattern")}, "WHERE pattern IS NOT NULL", f"'{k}' AS element, *")
        for k in KEYS
    ]
    return (
        "SELECT n.element, n.pattern, count(dosage) AS hits, CAST(coalesce(sum(dosage_count), 0) AS BIGINT) "
        f"AS total_count FROM {_values(names, 'n(element, pattern)')} LEFT JOIN ({' UNION ALL '.join(branches)}) h "
        "ON n.element = h.element AND n.pattern = h.pattern GROUP BY ALL"
    )


def _chosen_spans() -> str:
    branches = [
        _truth({"pattern": case_sql(f"{k}_pattern"), "captured": case_sql(f"{k}_captured")}, "WHERE pattern IS NOT NULL", f"'{k}' AS element, *")
        for k in KEYS
    ]
    return f"SELECT dosage, dosage_count, element, pattern, captured FROM ({' UNION ALL '.join(branches)})"


# FIXED VALUES: the inflected words of the corpus with their base forms, written by hand.
_INFLECTED = (
    "required require, puffs puff, hours hour, needed need, meals meal, minutes minute, times time, days day, tablets tablet, "
    "mls ml, waking wake, taken take, eyes eye, litres litre, spoonfuls spoonful, directed direct, weeks week, drops drop, "
    "affected affect, mondays monday, used use, capsules capsule, patches patch, sachets sachet, doses dose, sprays spray"
)


def _base_forms_sql() -> str:
    pairs = _values([tuple(p.split()) for p in _INFLECTED.split(", ")], "b(word, base)")
    words = _truth({"norm": case_sql("norm")}, select="dosage_count, unnest(regexp_split_to_array(norm, '[^a-z]+')) AS word")
    return (
        "SELECT w.word, coalesce(b.base, w.word) AS base, CAST(sum(dosage_count) AS BIGINT) AS total_count "
        f"FROM ({words}) w LEFT JOIN {pairs} ON b.word = w.word WHERE w.word <> '' GROUP BY ALL"
    )


def _vocabulary_sql() -> str:
    """Occurrences of vocabulary terms: sequences of words as spelled, and in base form where that differs."""
    rows = [(kind, term) for kind, term, _ in term_rows()]
    bases = [(word, base) for word, base in surface_forms().items()]
    words = "regexp_extract_all(norm, '[a-z]+(?:\\(s\\))?|[^a-z ]+')"
    sequences = " UNION ALL ".join(
        f"SELECT dosage, dosage_count, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS spelled, "
        f"array_to_string(list_slice(b, i, i + {n - 1}), ' ') AS based "
        f"FROM (SELECT *, unnest(range(1, len(w) - {n - 2})) AS i FROM forms WHERE len(w) >= {n})"
        for n in sorted({len(term.split()) for _, term in rows})
    )
    return (
        f"WITH bases AS (SELECT map_from_entries(list((word, base))) AS m FROM {_values(bases, 'v(word, base)')}), "
        f"texts AS (SELECT dosage, dosage_count, {words} AS w FROM ({_truth({'norm': case_sql('norm')})})), "
        "forms AS (SELECT *, list_transform(w, lambda x: coalesce(m[x], x)) AS b FROM texts, bases), "
        f"sequences AS ({sequences}), "
        "hits AS (SELECT spelled AS term, dosage_count FROM sequences UNION ALL "
        "SELECT based, dosage_count FROM sequences WHERE based <> spelled) "
        "SELECT t.list, t.term, count(h.term) AS occurrences, CAST(coalesce(sum(h.dosage_count), 0) AS BIGINT) AS total_count "
        f"FROM (SELECT row_number() OVER () AS n, * FROM {_values(rows, 'v(list, term)')}) t LEFT JOIN hits h ON h.term = t.term "
        "GROUP BY t.n, t.list, t.term"
    )


def _report_sizes(out: dict[str, str]) -> str:
    """Rows of written reports, from the SQL of the reports themselves."""
    sources = {
        "element_orders_mapped": out["A5"], "pattern_usage": out["A6"], "preprocessing_report": out["A8"],
        "random_sample": out["A2"], "captured_clean_summary": out["A1"],
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS report, count(*) AS n FROM ({sql})" for name, sql in sources.items())


def _rules_sql() -> str:
    rows = []
    for step, rule, to, regex in normalisation_rules():
        if step == "latin_dotted":  # without its closing dot, which the word boundary excludes
            regex = r"\b" + r"\.?".join(rule) + r"\b"
        rows.append((step, rule, to, regex))
    table = _values(rows, "r(step, original_form, normalized_to, regex)")
    return (
        "SELECT step, normalized_to, original_form, count(*) AS row_count "
        f"FROM ({_truth({})}) g, {table} WHERE regexp_matches(lower(g.dosage), r.regex) GROUP BY ALL"
    )


def oracle_sql() -> dict[str, str]:
    lines = f"SELECT {case_sql('text')} AS dosage FROM ({slots_sql()})"
    wide = f"SELECT {fill(templates.WIDE)} AS dosage FROM ({slots_sql()})"
    united = (
        f"SELECT dosage, count(*) AS dosage_count, true AS is_test FROM ({wide}) GROUP BY 1 UNION ALL "
        f"SELECT dosage, count(*) AS dosage_count, false AS is_test FROM ({lines}) GROUP BY 1"
    )
    keyed = (
        "SELECT dosage_lower, CAST(sum(dosage_count) AS BIGINT) AS dosage_count, count(*) AS variants "
        f"FROM ({_truth({'dosage_lower': case_sql('norm')})}) GROUP BY 1"
    )
    assessed = {
        "dosage_lower": case_sql("norm"), "buckets": case_sql("buckets", "''"), "exclude": _EXCLUDE,
        "cross_column_fail": case_sql("cross"), "mapped": _MAPPED,
    }
    when = {c: _final(c) for c in ("whenBare_clean", "whenBare_when")}
    daily = {f"periodElement_{c}": case_sql(f"final_periodElement_{c}")
             for c in ("clean", "period", "period_units", "frequency")}
    steps = {
        "N3": norm.LATIN, "N5": norm.NUMBER_WORDS, "N6": vocab.SPOON_SPELLINGS, "N7": norm.ISOLATED,
        "N8": vocab.DATE_SEPARATORS, "N9": vocab.NUMBER_RANGES,
        }
    screened = f"regexp_matches({_SQUEEZED.format('dosage')}, {literal(_re2(norm.screen_pattern()))})"
    tab = r"\b(?:tablet)\b", r"\b(?:tablets)\b", r"\b(?:capsule)\b"
    sample = {"m": _MAPPED, "buckets": case_sql("buckets", "''")}
    band = (
        "CASE WHEN dosage_count <= 10 THEN '1-10' WHEN dosage_count <= 100 THEN '11-100' "
        "WHEN dosage_count <= 1000 THEN '101-1000' ELSE '1000+' END"
    )
    grammar = f"CASE WHEN {_EXCLUDE} LIKE 'grammar_fail%' AND {_EXCLUDE} <> 'grammar_fail: S8' THEN {_EXCLUDE} END"
    out = {
        "SRC1_P1": f"SELECT dosage, count(*) AS dosage_count FROM ({lines}) GROUP BY 1",
        "SRC2_P2": united,
        "P3": keyed,
        "P4": f"SELECT dosage_lower, dosage_count FROM ({keyed}) WHERE dosage_count >= {BATCH_CUT}",
        "P5": (
            f"SELECT * EXCLUDE (total) FROM (SELECT *, sum(dosage_count) OVER (PARTITION BY dosage_lower) AS total "
            f"FROM ({_truth(assessed)})) WHERE total >= {BATCH_CUT}"
        ),
        "P9": (
            f"SELECT * EXCLUDE (total), false AS is_test FROM (SELECT *, sum(dosage_count) OVER (PARTITION BY dosage_lower) "
            f"AS total FROM ({_truth(assessed)})) WHERE total >= {BATCH_CUT}"
        ),
        "R13": _truth({c: f"coalesce('[' || {_final(c)} || ']', '[]')" for c in ARRAYS}),
        "P8_batch": (
            "SELECT dosage, dosage_count, dosage_lower, buckets, exclude, mapped FROM (SELECT *, sum(dosage_count) OVER "
            f"(PARTITION BY dosage_lower) AS total FROM ({_truth(assessed)})) WHERE total >= {BATCH_CUT}"
        ),
        "P6": united,
        "P7": (
            "SELECT dosage, dosage_count, dosage_lower, buckets FROM (SELECT *, max(dosage_count) OVER "
            f"(PARTITION BY dosage_lower) AS top FROM ({_truth(assessed, 'WHERE mapped')})) WHERE top >= {BATCH_CUT}"
        ),
        "X2": _base_forms_sql(),
        "X4_spans": _chosen_spans(),
        "E_readings": readings.hits_sql(),
        "F3_timing": readings.timing_sql(),
        "NV1_negative": readings.failures_sql(),
        "P8": f"SELECT dosage, count(*) AS dosage_count FROM ({lines}) GROUP BY 1 HAVING count(*) < {BATCH_CUT}",
        "N1": "SELECT doc_id, lower(text) AS text FROM documents",
        "N2": f"SELECT doc_id, {_SQUEEZED.format('text')} AS text FROM documents",
        **{name: _step_sql(terms) for name, terms in steps.items()},
        "N4": _truth({}, select=(
            f"dosage, dosage_count, CASE WHEN {screened} THEN '' ELSE {_SQUEEZED.format('dosage')} END AS text, "
            f"CASE WHEN {screened} THEN 'general_fail: removed' END AS exclude"
        )),
        "N10": _truth({}, select=f"dosage, dosage_count, {_tidy_sql('trim(dosage)')} AS text"),
        "N11": _truth({}, select="dosage, dosage_count, " + _replace_sql(
            "dosage", [(tab[0], "tab"), (tab[1], "tab"), (tab[2], "cap")]) + " AS text"),
        "N1_N10": _truth({
            "dosage_lower": case_sql("norm"),
            "exclude": f"CASE WHEN {_EXCLUDE} = 'general_fail: removed' THEN {_EXCLUDE} END",
        }),
        "X1": _truth({"glued": f"replace({case_sql('norm')}, ' ', '')"}),
        "X4_X5_X12": _truth({"dosage_elements": case_sql("tags")}),
        "X6": _truth(_expected("doseQuantity_clean", "methodDirect_clean"),
                     "WHERE doseQuantity_clean LIKE '% spray' OR doseQuantity_clean LIKE '% suck'"),
        "X10": _truth(_expected("doseQuantity_units", "doseQuantity_clean"), "WHERE dosage LIKE '%(s)%'"),
        "X11": _truth({"dosage_elements": case_sql("tags")}, "WHERE dosage_elements LIKE '%Dashed*%'"),
        "T1_T2": _truth({**daily, **when}, "WHERE periodElement_clean IS NOT NULL"),
        "T3_T4": _truth(when, "WHERE whenBare_clean IS NOT NULL"),
        "T6": _truth(
            {"extras_whenoffset": case_sql("whenBare_clean"), "o": case_sql("whenBare_offset")},
            "WHERE o <> ''", "dosage, dosage_count, extras_whenoffset, CAST(NULL AS STRING) AS whenBare_clean",
        ),
        "T7": _truth({"buckets": case_sql("buckets", "''")}),
        "T8": _truth({
            "dosage_lower": case_sql("norm"), "dosage_elements": case_sql("tags"), "buckets": case_sql("buckets", "''"),
            "exclude": _EXCLUDE, "mapped": _MAPPED,
        }),
        "T8_wide": (
            "SELECT dosage, count(*) AS dosage_count, '*methodDirect* *doseQuantity* *frequencyBare* *boundsDuration* "
            "*boundsAPeriodStartEnd*' AS dosage_elements, buckets, 'grammar_fail: S3' AS exclude, false AS mapped FROM "
            f"(SELECT {fill(templates.WIDE)} AS dosage, "
            f"{fill('take | <A> tablets | <C> times every day | for <Q> days | from <SHIP>')} AS buckets "
            f"FROM ({slots_sql()})) GROUP BY ALL"
        ),
        "V0_V1": _truth({"dosage_elements": case_sql("tags"), "grammar_fail": grammar}),
        "S1_S8_O1_O10": _exploded("exclude", "failed LIKE 'grammar_fail%'"),
        "NV1_NV10": _truth({"numeric_fail": _EXCLUDE}, "WHERE numeric_fail LIKE 'numeric_fail%'"),
        "V2_V3_V4": _truth({"dosage_spare": _SPARE, "exclude": _EXCLUDE, "mapped": _MAPPED}),
        "CC1_CC13_VC1_VC3": _exploded("cross", "failed IS NOT NULL"),
        "F1_F14": _truth(
            {"fhir": case_sql("fhir")}, "WHERE fhir IS NOT NULL",
            "dosage, dosage_count, " + ", ".join(
                f"CASE WHEN json_type(fhir, '$.{p}') = 'VARCHAR' THEN json_extract_string(fhir, '$.{p}') "
                f"ELSE CAST(json_extract(fhir, '$.{p}') AS STRING) END AS {p}" for p in PARTS),
        ),
        "F15": _truth({"fhir_json": _JSON}, "WHERE fhir_json IS NOT NULL"),
        "F16": _truth({"fhir_json_no_text": case_sql("fhir")}, "WHERE fhir_json_no_text IS NOT NULL"),
        "A1": _summary(),
        "A2": _truth(sample, "WHERE m ORDER BY md5('42:' || dosage), dosage LIMIT 200", "dosage, dosage_count, buckets"),
        "A3": (
            "SELECT dosage, dosage_count, frequency_band, buckets FROM (SELECT *, row_number() OVER (PARTITION BY "
            "frequency_band ORDER BY md5('42:' || dosage), dosage) AS rank FROM "
            f"({_truth(sample, 'WHERE m', f'*, {band} AS frequency_band')})) WHERE rank <= 200"
        ),
        "A4": _element_sample(),
        "A5": (
            "SELECT dosage_elements, arg_min(buckets, dosage) AS example_buckets, min(dosage) AS example_dosage, "
            "CAST(sum(dosage_count) AS BIGINT) AS total_count FROM "
            f"({_truth({**sample, 'dosage_elements': case_sql('tags')}, 'WHERE m')}) GROUP BY 1"
        ),
        "A6": _patterns_sql(),
        "A7": _vocabulary_sql(),
        "A8": _rules_sql(),
        "R3_R7": _coded_units(),
        "R8_R9": _coded_methods(),
        "R10_R11_R12": _coded_periods(),
    }
    for name, (kind, column) in WORDS.items():
        out[name] = readings.words_sql(kind, column)
    for name in ("R1", "R2", "R4_R5_R6"):
        out[name] = _truth({c: _REFINED_SQL[c] for c in REFINED[name]})
    for i, element in enumerate(ELEMENTS, start=1):
        key = element.key
        names = [f"{key}_{n}" for n in ("clean", "captured", "pattern", *element.fields)]
        out[f"E{i}"] = _truth(_expected(*names), f"WHERE {key}_clean IS NOT NULL")
    for i, key in enumerate(REGEX_ELEMENTS, start=1):
        names = [f"{key}_clean"] + (["route_adverbial"] if key == "route" else [])
        out[f"G{i}"] = _truth(_expected(*names), f"WHERE {key}_clean IS NOT NULL")
    out |= {"P8_counts": out["P5"], "SRC5_batch": out["P5"], "SRC4_SNK1_SNK2": out["P7"], "SNK3": _report_sizes(out)}
    out["SNK4"] = f"SELECT dosage, dosage_count, ' ' AS space, true AS stamped FROM ({out['P5']})"
    if corpus_queries:
        out.update(corpus_queries.oracle_sql())
    return out
