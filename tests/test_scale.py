"""What lets queries grow with their input: plans, and results on keys that many rows share."""

from gristmill.plans import registry
from gristmill.plans.ladders import dimensions

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_events_without_a_fact_are_not_dealt_to_one_task(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/pages.parquet").write.parquet(f"{tmp_path}/pages.parquet")
    d = dimensions(spark, str(tmp_path))
    assert "hashpartitioning(_told" in plan(d) and "hashpartitioning(fact" not in plan(d).split("== Physical Plan ==")[1].split("Aggregate")[0]
    assert d.count() == events.count() and d.where("repeated or first_id is not null").count() == 0


def test_texts_are_lowered_once_and_articles_stay_where_they_are(spark):
    shown = plan(registry.QUERIES["q_judgment_labels"](spark, SF)).split("== Physical Plan ==")[1]
    assert shown.count("lower(") <= 20 and "split_part(" not in shown


def test_dates_of_a_text_are_looked_for_once(spark):
    shown = plan(registry.QUERIES["q_content_dates"](spark, SF)).split("== Physical Plan ==")[1]
    assert shown.count("regexp_extract_all(") <= 14
