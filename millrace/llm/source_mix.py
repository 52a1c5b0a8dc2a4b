"""Mixing sources to target weights by Poisson replication.

Every source (or the rest, all sources without a weight of their own) has a mean repetition rate: its target
share of all characters over its present share. Each document's number of copies is the inverse of the Poisson
distribution with that rate at a number in [0, 1) hashed from seed, id and text, so a rerun, or another split of
the input, gives the same copies. Only rows without an id are told apart by their place in the input too. Copies are exploded and dealt out globally by another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh

WEIGHTS = {"src0": 0.15, "src1": 0.10, "src2": 0.10}  # shares of the mix; other sources share the rest
SEED = 11
MOST = 10_000.0  # largest mean number of copies; a source that would need more is refused
STEPS = 16  # standard deviations after which the distribution ends: less than one in 2**53 lies beyond


def uniform(seed: int, *values: Column) -> Column:
    """A number in [0, 1) with 52 random bits, hashed from the seed and the values."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(value.cast("string"), F.lit("")) for value in values))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_steps(rate: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, 2, ... as an array; empty for a rate of 0.

    Terms are carried as logarithms, so that a large rate does not vanish at its first term.
    """
    last = F.ceil(rate + F.lit(STEPS) * F.sqrt(rate) + F.lit(STEPS)).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("steps"))

    def add(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        total = state["total"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("total"), F.concat(state["steps"], F.array(total)).alias("steps"))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda state: state["steps"])
    refused = F.concat(F.lit("a source would be repeated "), rate.cast("string"), F.lit(f" times on average; at most {MOST} are possible"))
    steps = F.when(rate > MOST, F.raise_error(refused).cast("array<double>")).otherwise(steps)
    return F.when(rate > 0, steps).otherwise(F.array().cast("array<double>"))


def _inverse(steps: Column, at: Column) -> Column:
    """The smallest number whose cumulative probability is above ``at``."""
    start = F.struct(at.alias("at"), F.lit(0).alias("below"))
    return F.aggregate(
        steps,
        start,
        lambda state, step: F.struct(
            state["at"].alias("at"), (state["below"] + F.when(step <= state["at"], 1).otherwise(0)).alias("below")
        ),
        lambda state: state["below"],
    )


def mix_sources(
    docs: DataFrame, weights: Mapping[str, float] = WEIGHTS, seed: int = SEED,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """Copies of ``docs`` whose sources have the target shares of all characters, in a random global order.

    ``weights`` gives shares between 0 and 1, together at most 1; what is left of 1 goes to all other sources
    (a null source is one of them) in proportion to their size. Columns of ``docs`` are kept, and ``copy_no``
    (1, 2, ...), ``copies`` (of this document) and ``deal`` (the hash in [0, 1) by which copies are dealt out
    and sorted) are added; input columns of these names are replaced. A document without text is repeated like
    any other of its source; a weighted source without any text gets no copies, and neither does a
    group whose share is 0. Rows are drawn one by one, also those that share an id, or have none: without
    an id equal texts are told apart by where they stand in ``docs``; only rows of equal id and text have equal numbers of
    copies. A source that would need more than ``MOST`` copies of each document stops the job. An empty table gives an
    empty result.
    """
    if any(share < 0 for share in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares that add up to at most 1")
    part, steps, own = (fresh(docs, name) for name in ("mix_part", "mix_steps", "mix_own"))
    rest = max(0.0, 1 - sum(weights.values()))
    named = F.lit(-1)
    share = F.lit(rest)
    for number, (name, weight) in enumerate(sorted(weights.items())):
        named = F.when(F.col(source) == name, F.lit(number)).otherwise(named)
        share = F.when(F.col(part) == number, F.lit(float(weight))).otherwise(share)
    digest, place = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")), F.monotonically_increasing_id()
    numbered = F.when(F.col(doc_id).isNull(), F.concat_ws(":", digest, place.cast("string"))).otherwise(digest)
    known = docs.withColumns({part: named, own: numbered})
    sizes = known.groupBy(part).agg(F.sum(F.coalesce(F.length(text), F.lit(0))).alias("size"))
    # At most one row per weight and one for the rest: what is gathered and broadcast is bounded by the parameter.
    totals = sizes.agg(F.sum("size").alias("total"), F.collect_list(F.struct(part, "size")).alias("parts"))
    rates = totals.select("total", F.inline("parts")).where("size > 0")
    rates = rates.select(part, poisson_steps(share * F.col("total") / F.col("size")).alias(steps))
    drawn = known.join(F.broadcast(rates), part)
    copies = _inverse(F.col(steps), uniform(seed, F.col(doc_id), F.col(own))).cast("long")
    counted = drawn.withColumn("copies", copies).where("copies > 0").drop(part, steps)
    exploded = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    dealt = exploded.withColumn("deal", uniform(seed + 1, F.col(doc_id), F.col(own), F.col("copy_no"))).drop(own)
    return dealt.repartition("deal").sortWithinPartitions("deal", doc_id, "copy_no")
