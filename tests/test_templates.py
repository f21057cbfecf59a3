"""The generated corpus: texts are picked by number and filled as the CASE expression of the SQL says."""

from pyspark.sql import functions as F

from posofold.sources import templates


def test_filled_texts_are_those_of_the_case_expression(spark):
    names = [*templates.SLOTS, "SHIP"]
    rows = [(t, *(None if (t + k + i) % 7 == 0 else f"{k}{n.lower()}" for i, n in enumerate(names))) for t in range(-3, len(templates.blocks()) + 2) for k in range(9)]
    rows.append((None, *names))
    slots = spark.createDataFrame(rows, "template int, " + ", ".join(f"{n} string" for n in names))
    picked, text = templates.fill_sql("text")
    both = slots.selectExpr("*", picked).select(F.expr(text).alias("a"), F.expr(templates.case_sql("text")).alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]
    assert sum(r.a is None for r in both) > 40 and sum(r.a is not None for r in both) > 300


def test_instructions_compare_no_number_with_each_template(spark, tmp_path):
    """One comparison for each template made the time by row grow with their number."""
    columns = "1L l_orderkey, id l_partkey, 2L l_suppkey, 1 l_linenumber, 3D l_quantity, timestamp'2000-01-02' l_shipdate"
    spark.range(200).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = templates.instructions(spark, str(tmp_path))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("THEN concat") == 0 and made.where("dosage is not null").count() == 200
