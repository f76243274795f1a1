"""Mixing sources to target weights: a budget handed down a domain-language-source tree."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake.llm.common import FILE, ROW, WORD, located, set_aside, table, without
from topiclake.llm.registry import query
from topiclake.session import broadcast_if_small, written_table

LEVELS = ["domain", "language", "origin"]
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """Target weights of a mixture.

    `weights` gives whole weights by level and name, `default` the weight of every other name. The
    budget is `share` percent of the tokens there are; `epochs` bounds how often a document may be taken.
    """

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default: int = 1
    share: int = 60
    epochs: int = 2
    seed: int = 7


PRODUCTION = Mix(weights={"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "language": {"en": 5, "de": 2, "fr": 2, "es": 1}})
PIPELINE = Mix(weights=PRODUCTION.weights, share=90, epochs=1)


def words(text: Column) -> Column:
    """The token measure of a text: its words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def domain_of(source: Column) -> Column:
    """The domain of a source: four families by the number that ends its name; others are `other`."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(F.length(number) > 0, F.concat(F.lit("d"), (number.cast("int") % 4).cast("string"))).otherwise("other")


def _weight(level: str, mix: Mix) -> Column:
    named = mix.weights.get(level, {})
    out = F.lit(mix.default).cast("bigint")
    for name, weight in sorted(named.items()):
        out = F.when(F.col(level) == name, F.lit(weight).cast("bigint")).otherwise(out)
    return out


def _share_out(nodes: DataFrame, parents: list[str], level: str, mix: Mix) -> DataFrame:
    """Divide each parent's `budget` among its children by weight, none above its `room`.

    What a child cannot take goes to its siblings by their weights. Children are looked at in the
    order in which they fill up; the first that does not fill up ends the filled ones, and the rest
    divide what is left. The windows run over the children of one node of the tree, never over rows
    of documents. A weight of zero or less takes nothing.
    """
    weighed = nodes.withColumn("weight", F.greatest(_weight(level, mix), F.lit(0)))
    fills = F.when(F.col("weight") > 0, F.col("room").cast("double") / F.col("weight")).otherwise(F.lit(float("inf")))
    siblings = W.partitionBy(*parents)
    order = siblings.orderBy("fills", level)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    zero = F.lit(0).cast(EXACT)
    ranked = weighed.withColumn("fills", fills).withColumns({
        "before": F.coalesce(F.sum(F.col("room").cast(EXACT)).over(before), zero),
        "rest": F.coalesce(F.sum(F.col("weight").cast(EXACT)).over(rest), zero)})
    left = F.greatest(F.col("budget").cast(EXACT) - F.col("before"), zero)
    full = (F.col("weight") > 0) & (F.col("room").cast(EXACT) * F.col("rest") <= left * F.col("weight"))
    marked = ranked.withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("room").cast(EXACT))).over(siblings), zero)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0).cast(EXACT)).over(siblings)
    summed = marked.withColumns({"taken": taken, "open_weight": open_weight})
    part = F.expr(f"(cast(budget as {EXACT}) - taken) * weight div nullif(open_weight, 0)")
    given = F.when(F.col("full"), F.col("room")).otherwise(F.least(F.col("room"), F.coalesce(part.cast("bigint"), F.lit(0))))
    return summed.select(*parents, level, given.alias("budget"))


def leaf_budgets(leaves: DataFrame, budget: Column, mix: Mix) -> DataFrame:
    """Each leaf's budget, from the root down.

    A node's room is the room of its leaves, so a shortage is made up by siblings first and reaches
    the node's own siblings only when the whole branch is full. `leaves` has the three levels and `room`.
    """
    one = leaves.groupBy("domain").agg(F.sum("room").alias("room")).withColumn("root", F.lit(1))
    total = leaves.agg(budget.cast("bigint").alias("budget")).withColumn("root", F.lit(1))
    given = _share_out(one.join(total, "root"), ["root"], "domain", mix).drop("root")
    for depth in (1, 2):
        keys, level = LEVELS[:depth], LEVELS[depth]
        room = leaves.groupBy(*keys, level).agg(F.sum("room").alias("room"))
        given = _share_out(room.join(given, keys), keys, level, mix)
    return given


def _ticket(epoch: Column, mix: Mix) -> Column:
    """A document's place in the seeded order of one epoch."""
    return F.md5(F.concat_ws("-", F.lit(mix.seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def choose(docs: DataFrame, mix: Mix) -> DataFrame:
    """One row per document: doc_id, FILE, ROW, the three levels, n_tokens, leaf_budget, epochs.

    `epochs` is how often the mixture takes the document. A leaf's budget buys whole passes over the
    leaf first; the rest is a prefix of the seeded order of the next epoch, as long as it fits.

    A leaf may hold any share of all rows: its order is cut into 4096 blocks by the first digits of
    the ticket, block sums are added up per leaf, and rows are ordered only inside their block.

    Null or unknown sources form the domain `other`, null names the level `none`; null and empty texts
    have no tokens and are taken where they lie inside a prefix. Rows that share a doc_id share their
    ticket and are told apart by length. An empty table gives no rows; other columns are not looked at.
    """
    names = docs.columns
    source = F.col("source") if "source" in names else F.lit(None).cast("string")
    language = F.col("lang") if "lang" in names else F.lit(None).cast("string")
    rows = written_table(located(docs).select(
        "doc_id", FILE, ROW, domain_of(source).alias("domain"), F.coalesce(language, F.lit("none")).alias("language"),
        F.coalesce(source, F.lit("none")).alias("origin"), words(F.col("text")).alias("n_tokens")), "measured")

    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = written_table(leaves.withColumn("room", F.col("tokens") * mix.epochs), "leaves")
    budget = F.expr(f"sum(room) div {mix.epochs} * {mix.share} div 100")
    given = leaf_budgets(leaves, budget, mix).join(leaves.select(*LEVELS, "tokens"), LEVELS)
    passes = F.expr("coalesce(budget div nullif(tokens, 0), 0)")
    given = given.select(*LEVELS, F.col("budget").alias("leaf_budget"), passes.alias("passes"),
                         (F.col("budget") - passes * F.col("tokens")).alias("left"))
    given = written_table(given, "budgets")

    placed = rows.join(broadcast_if_small(given), LEVELS).withColumn("ticket", _ticket(F.col("passes"), mix))
    placed = placed.withColumn("block", F.substring("ticket", 1, 3))
    sums = placed.groupBy(*LEVELS, "block").agg(F.sum("n_tokens").alias("in_block"))
    upto = W.partitionBy(*LEVELS).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*LEVELS, "block", F.coalesce(F.sum("in_block").over(upto), F.lit(0)).alias("before"))
    inside = W.partitionBy(*LEVELS, "block").orderBy("ticket", "n_tokens", FILE, ROW)
    reach = F.col("before") + F.sum("n_tokens").over(inside.rowsBetween(W.unboundedPreceding, 0))
    extra = F.when((reach <= F.col("left")) & (F.col("left") > 0), 1).otherwise(0)
    return placed.join(sums, [*LEVELS, "block"]).select(
        "doc_id", FILE, ROW, *LEVELS, "n_tokens", "leaf_budget", (F.col("passes") + extra).cast("bigint").alias("epochs"))


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The records the mixture takes, each as often as it is taken, with the columns of `docs`."""
    docs, back = set_aside(docs)
    placed = located(docs)
    taken = choose(placed, mix)
    once = without(placed, taken.filter("epochs = 0"))
    if mix.epochs == 1:
        return once.withColumnsRenamed(back)
    again = taken.filter("epochs > 1").select(FILE, ROW, F.explode(F.expr("sequence(2, epochs)")).alias("__epoch"))
    return once.unionByName(placed.join(again, [FILE, ROW]).select(*once.columns)).withColumnsRenamed(back)


def _sql_level(parents: str, level: str, room: str, given: str, join: str, mix: Mix) -> str:
    cases = " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in sorted(mix.weights.get(level, {}).items()))
    weight = f"CASE {cases} ELSE {mix.default} END" if cases else str(mix.default)
    over = f"PARTITION BY {parents}" if parents else ""
    keys = f"{parents}, {level}" if parents else level
    return f"""
(SELECT {keys}, CASE WHEN filled THEN room ELSE least(room, CAST((budget - coalesce(sum(CASE WHEN filled THEN room END) OVER ({over}), 0))
  * weight // sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({over}) AS BIGINT)) END AS budget FROM
 (SELECT *, CAST(room AS HUGEINT) * rest <= greatest(budget - prior, 0) * weight AS filled FROM
  (SELECT *, coalesce(sum(room) OVER ({over} ORDER BY fills, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior,
    sum(weight) OVER ({over} ORDER BY fills, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM
   (SELECT *, CAST(room AS DOUBLE) / weight AS fills FROM
    (SELECT r.*, budget, {weight} AS weight FROM (SELECT {keys}, CAST(sum(room) AS BIGINT) AS room FROM {room} GROUP BY {keys}) r {join} {given})))))"""


def sql(mix: Mix) -> str:
    return rf"""
WITH rows_ AS (SELECT doc_id, CASE WHEN length(regexp_extract(source, '([0-9]{{1,9}})$', 1)) > 0
  THEN 'd' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % 4 AS VARCHAR) ELSE 'other' END AS domain,
 coalesce(lang, 'none') AS language, coalesce(source, 'none') AS origin,
 CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, language, origin, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * {mix.epochs} AS room FROM rows_ GROUP BY ALL),
total AS (SELECT CAST(sum(room) AS BIGINT) // {mix.epochs} * {mix.share} // 100 AS budget FROM leaves),
g0 AS {_sql_level("", "domain", "leaves", "total", "CROSS JOIN", mix)},
g1 AS {_sql_level("domain", "language", "leaves", "g0 USING (domain)", "JOIN", mix)},
g2 AS {_sql_level("domain, language", "origin", "leaves", "g1 USING (domain, language)", "JOIN", mix)},
b AS (SELECT domain, language, origin, budget, coalesce(budget // nullif(tokens, 0), 0) AS passes,
 budget - coalesce(budget // nullif(tokens, 0), 0) * tokens AS remaining FROM g2 JOIN leaves USING (domain, language, origin)),
t AS (SELECT *, md5('{mix.seed}-' || passes || '-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ticket FROM rows_ JOIN b USING (domain, language, origin)),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY ticket, n_tokens ROWS UNBOUNDED PRECEDING) AS reach FROM t)
SELECT doc_id, domain, language, origin, n_tokens, budget AS leaf_budget,
 CAST(passes + CASE WHEN reach <= remaining AND remaining > 0 THEN 1 ELSE 0 END AS BIGINT) AS epochs FROM c"""


@query("op10_mixing", sql(PRODUCTION))
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choose(table(spark, sf_dir, "documents"), PRODUCTION).drop(FILE, ROW)
