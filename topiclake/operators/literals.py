"""Patterns found by a literal that every match must hold, wherever it stands.

A pattern such as `(eu|us)_orders_v[0-9]+` has no literal start, but no topic without `_orders_v` can match it.
Each such pattern is filed under one gram of up to GRAM characters of its longest literal, the one fewest topics hold, and
topics meet patterns by an equi-join on their own grams. Only pairs that share the filed gram and hold the whole
literal are given to the regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
NESTING = 8
CUT = "\x01"
PLAIN_ESCAPE = r"\\[dDwWsSbB]|\\[^A-Za-z0-9]"


def required_literal(pattern: Column) -> Column:
    """The longest text every full match of `pattern` must contain; empty when none is known.

    What may be missing or is not a single character is cut out: groups with all they hold, character classes, repeated or optional
    characters, escapes. A pattern that is an alternation itself, has flags, look-around, quotation, numbered escapes
    or nested classes is not looked into.
    """
    rest = F.replace(pattern, F.lit("(?:"), F.lit("("))
    rest = F.regexp_replace(rest, PLAIN_ESCAPE, CUT)
    rest = F.regexp_replace(rest, r"\[[^\[\]]*\]", CUT)
    for _ in range(NESTING):
        rest = F.regexp_replace(rest, r"\((?!\?)[^()]*\)", CUT)
    opaque = F.rlike(rest, F.lit(r"[()|\\\[\]]"))
    rest = F.regexp_replace(rest, r"(?s).\{[^}]*\}", CUT)
    rest = F.regexp_replace(rest, r"(?s).[?*]", CUT)
    pieces = F.split(rest, f"[{CUT}+.^$?*]+")
    longest = F.array_max(F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"), p.alias("text"))))["text"]
    return F.when(opaque, F.lit("")).otherwise(F.coalesce(longest, F.lit("")))


def grams(text: Column, size: Column) -> Column:
    """The distinct substrings of `size` characters; none of a shorter text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def pairs_by_literal(topics: DataFrame, patterns: DataFrame) -> DataFrame:
    """(topic, pattern, id) where the topic holds the pattern's `literal`, which must not be empty.

    A literal shorter than GRAM is its own gram. A pattern with a gram no topic has can match nothing and drops out.
    """
    sized = patterns.withColumn("size", F.least(F.length("literal"), F.lit(GRAM)))
    sizes = F.broadcast(sized.select("size").distinct())  # at most GRAM numbers
    held = topics.select("topic").join(sizes, F.length("topic") >= F.col("size")).select(
        "topic", F.explode(grams(F.col("topic"), F.col("size"))).alias("gram"))
    wanted = sized.select("pattern", F.explode(grams(F.col("literal"), F.col("size"))).alias("gram"))
    frequency = held.join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counted = wanted.join(frequency, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    filed = counted.groupBy("pattern").agg(F.min(F.struct("n", "gram")).alias("least")).filter("least.n > 0")
    filed = filed.select("pattern", F.col("least.gram").alias("gram")).join(patterns, "pattern")
    return held.join(filed, "gram").filter(F.contains(F.col("topic"), F.col("literal"))).select("topic", "pattern", "id")
