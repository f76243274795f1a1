import random
import re

import pytest
from pyspark.sql import functions as F

from topiclake.operators import literals, routing


@pytest.mark.parametrize("pattern,literal", [
    (".*_click_[0-9]+", "_click_"), ("(eu|us)_orders", "_orders"), ("(?:a|b)cd(e(f))*g", "cd"), ("[abc]x{2}yz", "yz"), (".*", ""),
    ("a|b", ""), ("(?i)LOUD", ""), (r".*\Qab\E", ""), (r"\d+-total", "-total"), (r".\x41bc", ""), ("[a&&[b]]cde", ""), ("x?abc+?d", "abc"),
    (".*ab??cc", "cc"), (r".*\(zz", "zz"), ("[]a]bc", ""), ("[^)(]ab", "ab"), (r"(.)\1abc", ""), (".ab{0,2}", "a"), ("(ab)?+cd", "cd")])
def test_required_literal(spark, pattern, literal):
    assert spark.range(1).select(literals.required_literal(F.lit(pattern))).first()[0] == literal


def test_random_patterns_match_as_when_all_are_tried(spark):
    rng = random.Random(5)
    piece = lambda: rng.choice(["a", "b", "ab", "ba", "c", ".", "[ab]", "(a|bc)", "(?:ca)", "b?", "c*", "a+", "b{2}", "(ab)?", r"\w", "(a(b|c))+", "c??", r"\."])
    patterns = sorted({"".join(piece() for _ in range(rng.randint(1, 5))) for _ in range(300)})
    topics = sorted({"".join(rng.choice("abc.") for _ in range(rng.randint(0, 6))) for _ in range(250)})
    configs = spark.createDataFrame([(n, p, "REGEX") for n, p in enumerate(patterns)], "id long, topic_name string, match_type string")
    found = routing._candidates(spark.createDataFrame([(t,) for t in topics], "topic string"), configs)
    want = {(t, n) for n, p in enumerate(patterns) for t in topics if re.fullmatch(p, t)}
    got = [(r.topic, r.id) for r in found.collect()]
    assert set(got) == want and len(got) == len(want) > 300


def test_few_pairs_are_given_to_the_expression(spark):
    topics = spark.range(20_000).select(F.format_string("region%d_stream_%05d", F.col("id") % 7, "id").alias("topic"))
    patterns = spark.range(5_000).select("id", F.format_string("(a|r)egion[0-9]_stream_%05d[0-9]?", F.col("id") * 3).alias("pattern"))
    tried = literals.pairs_by_literal(topics, patterns.withColumn("literal", literals.required_literal(F.col("pattern"))))
    assert tried.count() == 5_000  # of 100,000,000 pairs


def test_nothing_to_match(spark):
    none = spark.createDataFrame([], "pattern string, id long, literal string")
    topics = spark.createDataFrame([("t",), ("",), (None,)], "topic string")
    assert literals.pairs_by_literal(topics, none).count() == 0
    some = spark.createDataFrame([(".*tt", 1, "tt"), (".*t", 2, "t")], none.schema)
    assert [tuple(r) for r in literals.pairs_by_literal(topics, some).collect()] == [("t", ".*t", 2)]
    assert literals.pairs_by_literal(topics.limit(0), some).count() == 0
