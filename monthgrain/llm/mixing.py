"""Mixing sources to target weights by Pareto order sampling; DataFrame operations only.

Every source gets a target in units of size (words, say): the sources share the whole by weight, no
target is above max_copies times its source's size, and what a capped source can't take goes to the
others by weight. A document is expected to be taken target / source size times (times its own
weight, if there is such a column). The whole part of that is certain. For the rest, pi, documents
are ranked by Pareto's ratio

    (u / (1 - u)) / (pi / (1 - pi)),    u uniform, from a hash of the id

and the first ones are taken up to the size that the source still lacks: a sample of fixed size, with
unequal probabilities between and (given weights) within sources. What a document of great weight can't take
for the cap isn't passed on to others, so with weights a source near its cap may stay under its target. The document at the edge is taken
if more than half of it fits, so a source ends within half a document of its target.

A hot source isn't ordered in one task: ratios fall in some sqrt(n) bins, sizes are summed by bin,
and documents are ordered only within their bin. Only ids and sizes are shuffled for that: what a
source takes is all up to some ratio, so `mix` compares each document with that of its source.

Defined cases: null text has size 0 and nothing is taken of it; the null source is a source of its
own, last in order; very long texts count whole, and one too long for what is left is the last that is
looked at; repeated ids have equal u, and are ordered by size; repeated rows are each counted; an empty
table gives an empty result; reruns give equal results; other columns pass through (`mix`) or are
dropped (`decide`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"
#: Sources up to which their table, of some 100 bytes a row, is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 100_000
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number inside (0, 1) from 52 bits of a hash of key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size (one row each) to these and target.

    Sources in order of cap / weight are capped as long as their share of what is left is at least
    their cap; all others share the rest. This has a row a source, so one task orders them."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before, onward = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    return (
        sources.select("source", "source_size", weight.alias("weight"))
        .withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(Window.partitionBy(F.lit(1)).rowsBetween(*_ALL)).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("capped", F.col("room") <= F.col("level"))
        .withColumn("open_level", F.max(F.when(~F.col("capped"), F.col("level"))).over(Window.partitionBy(F.lit(1)).rowsBetween(*_ALL)))
        .select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("open_level") * F.col("weight")).alias("target"))
    )


def _plan(narrow: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """By source (_of): its size and target, its size times weight, and into how many bins its ratios go."""
    totals = cut(narrow.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.sum(F.col("_size") * F.col("_weight")).alias("_weighted"), F.count("*").alias("_n")))
    targets = source_targets(totals.select(F.col("_source").alias("source"), "source_size"), weights, max_copies)
    return cut(
        totals.drop("source_size").join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .select(F.col("_source").alias("_of"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "_weighted", F.ceil(F.sqrt("_n")).alias("_bins"))
    )


def _with_ratio(df: DataFrame, plan: DataFrame, max_copies: int, seed: str) -> DataFrame:
    """df (_id, _source, _size, _weight) with its source's plan, _whole, _u, _ratio and _bin."""
    per_unit = F.when(F.col("_weighted") > 0, F.col("_target") / F.col("_weighted")).otherwise(F.lit(0.0))
    u = uniform(F.col("_id"), seed)
    pi = F.least(F.greatest(F.col("_expected") - F.col("_whole"), F.lit(1e-12)), F.lit(1 - 1e-12))
    mean_pi = F.least(F.greatest(F.col("_mean") - F.floor("_mean"), F.lit(1e-12)), F.lit(1 - 1e-12))
    scaled = F.col("_ratio") * (mean_pi / (1 - mean_pi))
    return (
        df.join(F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan, F.col("_source").eqNullSafe(F.col("_of")))
        .withColumn("_expected", F.least(F.col("_weight") * per_unit, F.lit(float(max_copies))))
        .withColumn("_mean", F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0)))
        .withColumn("_whole", F.floor("_expected"))
        .withColumn("_u", u)
        .withColumn("_ratio", F.when(F.col("_whole") >= max_copies, F.lit(float("inf"))).otherwise((F.col("_u") / (1 - F.col("_u"))) / (pi / (1 - pi))))
        .withColumn("_bin", F.when(F.col("_ratio") == float("inf"), F.col("_bins")).otherwise(F.least(F.floor(scaled / (1 + scaled) * F.col("_bins")), F.col("_bins") - 1)))
    )


def _planned(rows: DataFrame, narrow: DataFrame, plan: DataFrame, max_copies: int, seed: str) -> DataFrame:
    """rows with _id, _source, _size, _weight to these and _source_size, _target, _copies."""
    by_bin = _with_ratio(narrow, plan, max_copies, seed).groupBy("_of", "_bin").agg(F.sum("_size").alias("_bin_size"), F.sum(F.col("_size") * F.col("_whole")).alias("_bin_whole"))
    in_order = Window.partitionBy("_of").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    edges = by_bin.select(
        F.col("_of").alias("_edge_of"), F.col("_bin").alias("_edge_bin"),
        F.coalesce(F.sum("_bin_size").over(in_order), F.lit(0)).alias("_before"),
        F.sum("_bin_whole").over(Window.partitionBy("_of").rowsBetween(*_ALL)).alias("_certain"),
    )
    within = Window.partitionBy("_of", "_bin").orderBy("_ratio", "_u", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.col("_before") + F.coalesce(F.sum("_size").over(within), F.lit(0)) + F.col("_size") / 2.0
    return (
        _with_ratio(rows, plan, max_copies, seed).join(edges, F.col("_of").eqNullSafe(F.col("_edge_of")) & (F.col("_bin") == F.col("_edge_bin")))
        .withColumn("_reach", reach)
        .withColumn("_copies", F.when(F.col("_size") > 0, F.col("_whole") + F.when((F.col("_whole") < max_copies) & (F.col("_reach") <= F.col("_target") - F.col("_certain")), 1).otherwise(0)).otherwise(0).cast("int"))
    )


def _narrow(docs: DataFrame, size: Column, weight: Column | None) -> DataFrame:
    return docs.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), size.alias("_size"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("_weight"))


def decide(docs: DataFrame, size: Column, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, copies."""
    narrow = cut(_narrow(docs, size, weight))
    planned = _planned(narrow, narrow, _plan(narrow, weights, max_copies), max_copies, seed)
    return planned.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"))


def mix(docs: DataFrame, size: Column, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """The documents of the mix, all their columns, each as often as it is taken."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"), size.alias("_size"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("_weight"))
    narrow = cut(_narrow(docs, size, weight))
    plan = _plan(narrow, weights, max_copies)
    decided = cut(_planned(narrow, narrow, plan, max_copies, seed).filter("_size > 0 AND _whole < " + str(max_copies)).select("_of", F.struct("_ratio", "_u", "_id", "_size").alias("_place"), (F.col("_copies") > F.col("_whole")).alias("_more")))
    last = cut(decided.filter("_more").groupBy("_of").agg(F.max("_place").alias("_last")))
    beyond = decided.filter("NOT _more").join(last.withColumnRenamed("_of", "_last_of"), F.col("_of").eqNullSafe(F.col("_last_of")) & (F.col("_place") <= F.col("_last")))
    if beyond.isEmpty():
        known = plan.join(last.withColumnRenamed("_of", "_last_of"), F.col("_of").eqNullSafe(F.col("_last_of")), "left").drop("_last_of")
        more = F.coalesce(F.struct("_ratio", "_u", "_id", "_size") <= F.col("_last"), F.lit(False)) & (F.col("_whole") < max_copies)
        planned = _with_ratio(rows, cut(known), max_copies, seed).withColumn("_copies", F.when(F.col("_size") > 0, F.col("_whole") + more.cast("int")).otherwise(0).cast("int"))
    else:  # the last one that is taken has its equals, of which not all are
        planned = _planned(rows, narrow, plan, max_copies, seed)
    taken = planned.filter(F.col("_copies") > 0).select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    return taken.select("_row.*")


#: DuckDB SQL for the rows of op4_mixing.
SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
roomed AS (SELECT *, CAST(source_size * 3 AS DOUBLE) AS cap, CAST(source_size * 3 AS DOUBLE) / weight AS room FROM sources),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM roomed),
opened AS (SELECT *, max(CASE WHEN room > level THEN level END) OVER () AS open_level FROM levels),
targets AS (SELECT source, source_size, CASE WHEN room <= level THEN cap ELSE open_level * weight END AS target FROM opened),
planned AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, s.u,
         CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 3) ELSE 0 END AS whole
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id NULLS FIRST, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0 AS reach
  FROM planned)
SELECT doc_id, size, source_size, round(target, 3) AS target,
       CAST(CASE WHEN size = 0 THEN 0
            ELSE size * (whole + CASE WHEN whole < 3 AND reach <= target - whole * source_size THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM ranked
"""
