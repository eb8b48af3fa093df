"""Mixing sources to target weights: temperature mixing realised as budgeted block permutations.

Method. A source's share of all tokens (words) is raised to an exponent and normalised to its
weight. The exponent is bisected: it is the largest in 0..1 that gives the weights `entropy` times
the greatest possible entropy, or, where that would repeat a source more than `repeats` times, the
smallest that does not. The budget is given in tokens, or is the least at which every source gets
a whole epoch. A source's quota, weight times budget, is as many whole epochs as fit and a part of
one. Each epoch is a permutation of the source's blocks and of the documents in each block, by a
hash of seed, epoch and block or document; the part of an epoch takes documents in that order until
the quota is met, so it oversteps by one document at most.

A source is dealt into blocks by its documents' hashes, up to `MOST_BLOCKS`, so that no task has to
order a source: only block totals are added up in order, and one block's documents. The driver gets
one number for each source.

Input cases. Text null or empty: no tokens; such documents go with their block. A null source is
the source ''. A source without tokens has weight 0 and its rows are taken once. Null or repeated
ids are ordered by the same hash and each row counts. An empty table gives no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirlens.llm import tables

ENTROPY, REPEATS, SEED = 0.95, 4.0, 17
BLOCK_TOKENS, MOST_BLOCKS, STEPS = 65_536, 4096, 60
#: Sources up to which their plan is broadcast; more are joined by shuffling.
BROADCAST_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def weights(shares: list[float], exponent: float) -> list[float]:
    raised = [p**exponent for p in shares]
    total = sum(raised)
    return [x / total for x in raised]


def least_budget(tokens: list[int], weight: list[float]) -> float:
    """The budget at which the source with the smallest quota for its size gets one epoch."""
    return max(t / w for t, w in zip(tokens, weight, strict=True))


def bisect(far_enough: Callable[[float], bool]) -> tuple[float, float]:
    """(lo, hi) about the exponent below which far_enough holds."""
    lo, hi = 0.0, 1.0
    for _ in range(STEPS):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if far_enough(middle) else (lo, middle)
    return lo, hi


def exponent(tokens: list[int], entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> float:
    total = sum(tokens)
    shares = [t / total for t in tokens]

    def spread(e: float) -> bool:
        return -sum(w * math.log(w) for w in weights(shares, e)) >= entropy * math.log(len(shares))

    def repeated(e: float) -> bool:
        weight = weights(shares, e)
        all_tokens = least_budget(tokens, weight) if budget is None else budget
        return max(w * all_tokens / t for t, w in zip(tokens, weight, strict=True)) > repeats

    wide = 1.0 if spread(1.0) else bisect(spread)[0]
    return max(wide, bisect(repeated)[1] if repeated(wide) else 0.0)


def plan(tokens: dict[str, int], entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> list[tuple[str, float, int, int, int]]:
    """(source, weight, whole epochs, tokens of a further epoch, blocks) of every source."""
    some = sorted(s for s, t in tokens.items() if t > 0)
    out = [(s, 0.0, 1, 0, 1) for s, t in sorted(tokens.items()) if t <= 0]
    if some:
        sizes = [tokens[s] for s in some]
        weight = weights([t / sum(sizes) for t in sizes], exponent(sizes, entropy, repeats, budget))
        all_tokens = least_budget(sizes, weight) if budget is None else budget
        for s, t, w in zip(some, sizes, weight, strict=True):
            quota = round(w * all_tokens)
            out.append((s, w, quota // t, quota % t, min(MOST_BLOCKS, -(-t // BLOCK_TOKENS))))
    return out


def number(*parts: Column) -> Column:
    """A number below 2**60 from the MD5 of the parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """The training order of docs (doc_id, source, text): one row for each time a document is read.

    doc_id, source, n_tokens, weight of the source, epoch, block, and block_order and doc_order:
    an epoch of a source is read in order of (block_order, block, doc_order).
    """
    spark = docs.sparkSession
    seeded, doc = F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"))
    rows = rows.withColumn("number", number(seeded, doc))
    rows = tables.cut(rows)
    tokens = {r["source"]: r["t"] for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    planned = spark.createDataFrame(plan(tokens, entropy, repeats, budget), "source string, weight double, whole long, rest long, blocks long")
    dealt = rows.join(F.broadcast(planned) if len(tokens) <= BROADCAST_SOURCES else planned, "source").withColumn("block", F.col("number") % F.col("blocks"))
    last = number(seeded, F.col("whole").cast("string"), F.col("source"), F.col("block").cast("string"))
    sizes = dealt.where("rest > 0").groupBy("source", "block", "whole", "rest").agg(F.sum("n_tokens").alias("size")).withColumn("place", last)
    earlier = Window.partitionBy("source").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    cut = tables.cut(sizes.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0))).where("start < rest").select("source", "block", "start", (F.col("start") + F.col("size") <= F.col("rest")).alias("all_of_it")))
    # a source has one block that the quota ends in; only its documents are put in order
    own = number(seeded, F.col("whole").cast("string"), doc)
    before = Window.partitionBy("source", "block").orderBy("own", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ending = dealt.join(cut.where("not all_of_it").select("source", "block", "start"), ["source", "block"]).withColumn("own", own)
    part = ending.withColumn("more", (F.col("start") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0)) < F.col("rest")).cast("int")).drop("start", "own")
    full = dealt.join(cut.where("all_of_it").select("source", "block"), ["source", "block"], "left_semi").withColumn("more", F.lit(1))
    none = dealt.join(cut.select("source", "block"), ["source", "block"], "left_anti").withColumn("more", F.lit(0))
    taken = part.unionByName(full).unionByName(none)
    times = taken.where("whole + more > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("whole") + F.col("more") - 1).cast("int"))))
    epoch = F.col("epoch").cast("string")
    return times.select(
        "doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "epoch", "block",
        number(seeded, epoch, F.col("source"), F.col("block").cast("string")).alias("block_order"), number(seeded, epoch, doc).alias("doc_order"),
    )


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(tables.read(spark, sf_dir, "documents"))


def _number(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({" || ':' || ".join(parts)}), 1, 15) AS BIGINT)"


_RAISED = "list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2)))"
SQL = rf"""
WITH RECURSIVE tok AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n,
    {_number(f"'{SEED}'", "coalesce(CAST(doc_id AS VARCHAR), '')")} AS number FROM documents
), src AS MATERIALIZED (
  SELECT source, CAST(sum(n) AS BIGINT) AS t FROM tok GROUP BY source
), ps AS MATERIALIZED (
  SELECT list(t / total ORDER BY source) AS p FROM (SELECT source, t, sum(t) OVER () AS total FROM src WHERE t > 0)
), wide AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  SELECT i + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END FROM (
    SELECT i, lo, hi, ln({_RAISED}) - list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2) * ln(x))) * (lo + hi) / 2 / {_RAISED} >= {ENTROPY} * ln(len(p)) AS ok
    FROM wide, ps WHERE i < {STEPS})
), few AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  SELECT i + 1, CASE WHEN over THEN (lo + hi) / 2 ELSE lo END, CASE WHEN over THEN hi ELSE (lo + hi) / 2 END FROM (
    SELECT i, lo, hi, pow(list_max(p) / list_min(p), 1 - (lo + hi) / 2) > {REPEATS} AS over FROM few, ps WHERE i < {STEPS})
), chosen AS MATERIALIZED (
  SELECT greatest((SELECT CASE WHEN -list_sum(list_transform(p, lambda x: x * ln(x))) >= {ENTROPY} * ln(len(p)) THEN 1 ELSE (SELECT max(lo) FROM wide) END FROM ps), (SELECT min(hi) FROM few)) AS e
), weighted AS (
  SELECT source, t, pow(t / sum(t) OVER (), e) / sum(pow(t / total, e)) OVER () AS w
  FROM (SELECT source, t, sum(t) OVER () AS total FROM src WHERE t > 0), chosen
), quotas AS (
  SELECT source, t, w, CAST(round(w * max(t / w) OVER ()) AS BIGINT) AS quota FROM weighted
), planned AS MATERIALIZED (
  SELECT source, w, quota // t AS whole, quota % t AS rest, least({MOST_BLOCKS}, (t + {BLOCK_TOKENS} - 1) // {BLOCK_TOKENS}) AS blocks FROM quotas
  UNION ALL SELECT source, 0, 1, 0, 1 FROM src WHERE t = 0
), dealt AS MATERIALIZED (
  SELECT tok.*, w, whole, rest, number % blocks AS block FROM tok JOIN planned USING (source)
), sizes AS (
  SELECT source, block, rest, sum(n) AS size, {_number(f"'{SEED}'", "whole", "source", "block")} AS place FROM dealt WHERE rest > 0 GROUP BY source, block, whole, rest
), starts AS (
  SELECT source, block, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sizes
), ordered AS (
  SELECT d.*, coalesce(start + coalesce(sum(n) OVER (PARTITION BY d.source, d.block
    ORDER BY {_number(f"'{SEED}'", "whole", "coalesce(CAST(doc_id AS VARCHAR), '')")}, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest, false) AS more
  FROM dealt d LEFT JOIN starts s ON d.source = s.source AND d.block = s.block
), times AS (
  SELECT *, unnest(range(CAST(whole + CAST(more AS BIGINT) AS BIGINT))) AS epoch FROM ordered
)
SELECT doc_id, source, CAST(n AS BIGINT) AS n_tokens, round(w, 9) AS weight, CAST(epoch AS INTEGER) AS epoch, block,
  {_number(f"'{SEED}'", "epoch", "source", "block")} AS block_order, {_number(f"'{SEED}'", "epoch", "coalesce(CAST(doc_id AS VARCHAR), '')")} AS doc_order
FROM times
"""
