"""The order of quality rules comes from their cost and selectivity, not from the clock's noise."""

from pyspark.sql import functions as F

from gridmetrics.llm import quality
from gridmetrics.llm.quality import TEXT, WORDS, Rule, default_rules, ordered

SF_DIR = "/root/testdata/sf0.1"


def names(rules):
    return [rule.name for rule in rules]


def test_same_order_in_five_calls(spark):
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text")
    orders = [names(ordered(texts, default_rules(), 500)) for _ in range(5)]
    assert all(order == orders[0] for order in orders), orders


def test_slow_and_idle_rules_move_back(spark):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    half = F.length(TEXT) % 2 == 0
    slow = F.aggregate(F.sequence(F.lit(1), F.lit(3000)), F.length(TEXT), lambda a, b: (a * 31 + b) % 1009) >= 0
    rules = [Rule("never", F.size(WORDS) < 0), Rule("slow", slow & half), Rule("fast", half), Rule("seldom", half & (F.length(TEXT) % 64 == 0))]
    for _ in range(3):
        order = names(ordered(texts, rules, 300))
        assert order[0] == "fast" and order[-1] == "never"
        assert order.index("slow") > order.index("fast")
    assert names(ordered(texts.limit(0), rules, 300)) == names(rules)


def test_sample_is_of_the_whole_table(spark):
    """A rule that rejects the end of a table only is found to reject."""
    texts = spark.range(20_000).select(F.when(F.col("id") < 15_000, "calm words").otherwise("bad words").alias("text")).repartition(4)
    rules = [Rule("none", F.size(WORDS) < 0), Rule("bad", F.col(TEXT).startswith("bad"))]
    assert names(ordered(texts.sort(F.col("text").desc()), rules, 200)) == ["bad", "none"]
    found = quality.quality_cascade(texts, rules).groupBy("failed_rule").count().collect()
    assert {row.failed_rule: row["count"] for row in found} == {None: 15_000, "bad": 5000}
