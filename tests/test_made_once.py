from pyspark.sql import functions as F

from corpusloom.functions import matches as M
from corpusloom.session import setting


def plan(spark, column):
    with setting(spark, "spark.sql.debug.maxToStringFields", "1000"):
        return spark.createDataFrame([(1, "x")], "i int, text string").select(column.alias("x"))._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_cut_once(spark):
    """A text's pieces and matches stand in the plan once: within a lambda they would be made anew for each piece."""
    cuts = plan(spark, M.subsections(F.col("text")))
    assert cuts.count("split(text") == 1
    found = plan(spark, M.statute_sections(F.col("text")))
    assert found.count("split(text") == 1 and found.count("regexp_extract_all(text") == 1


def test_many_pieces(spark):
    text = "".join(f"\n(a) part {i}." for i in range(5000))
    law = "".join(f"(720 ILCS 5/{i})\nSec. {i}. Name {i}. " for i in range(5000))
    row = spark.createDataFrame([(text, law)], "text string, law string").select(M.subsections(F.col("text")).alias("a"), M.statute_sections(F.col("law")).alias("b")).first()
    assert row.a == [f"(a) part {i}." for i in range(5000)]
    assert [(x.citation, x.heading) for x in row.b] == [(f"720 ILCS 5/{i}", f"Name {i}") for i in range(5000)]
