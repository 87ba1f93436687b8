"""Weak supervision with SQL functions only: voters vote or abstain, expectation-maximisation finds how far each can be trusted.

A vote is 1 (yes), 0 (no) or null (abstains). Rows are first counted by vote pattern, of which there are at most 3 ** voters
whatever the corpus, so that the fit is one row's work. The model has two accuracies for each voter, on true yes rows
and on true no rows, and a prior for yes; votes are taken as independent given the truth, and abstaining tells nothing.
"""

from __future__ import annotations

from functools import reduce
from math import log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm.common import let

ROUNDS = 30
#: Accuracies stay within these bounds, so that no voter counts as certain.
LEAST, MOST = 0.02, 0.998
#: The two accuracies of a voter add up to 1 + EDGE at least: a vote never speaks for the other side.
EDGE = 0.02


def patterns(votes: DataFrame, voters: list[str]) -> DataFrame:
    """Counts of vote patterns: votes (array<int>), n."""
    return votes.groupBy(F.array(*[F.col(v).cast("int") for v in voters]).alias("votes")).agg(F.count(F.lit(1)).alias("n"))


def posterior(votes: Column, yes: Column, no: Column, prior: Column) -> Column:
    """Probability of yes given an array of votes, each voter's accuracy on yes rows and on no rows, and the share of yes."""
    both = F.zip_with(yes, no, lambda y, n: F.struct(F.log(y / (1 - n)).alias("one"), F.log((1 - y) / n).alias("zero")))
    odds = F.aggregate(F.zip_with(votes, both, lambda v, w: F.when(v == 1, w["one"]).when(v == 0, w["zero"]).otherwise(0.0)), F.log(prior / (1 - prior)), lambda s, x: s + x)
    return 1 / (1 + F.exp(-odds))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def fit(counted: DataFrame, voters: int, prior: float, yes: float, no: float, rounds: int = ROUNDS, weight: float = 10.0) -> DataFrame:
    """One row: yes, no (array<double>), prior. weight: rows that the starting values count as, which settles voters that hardly vote.

    Patterns come in a fixed order, so that sums are the same in every run. Without patterns the starting values stay.
    """
    # At most 3 ** voters rows meet here.
    rows = counted.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("rows"))
    start = F.struct(F.array_repeat(F.lit(yes), voters).alias("yes"), F.array_repeat(F.lit(no), voters).alias("no"), F.lit(prior).alias("prior"))

    def accuracy(j: int, seen: Column, vote: int, share, begin: float) -> Column:
        right = F.transform(seen, lambda s: F.when(s["votes"][j] == vote, s["n"] * share(s["p"])).otherwise(0.0))
        voted = F.transform(seen, lambda s: F.when(s["votes"][j].isNull(), F.lit(0.0)).otherwise(s["n"] * share(s["p"])))
        return F.greatest(F.lit(LEAST), F.least(F.lit(MOST), (_total(right) + weight * begin) / (_total(voted) + weight)))

    def step(state: Column, _: Column) -> Column:
        seen = F.transform("rows", lambda r: F.struct(r["votes"].alias("votes"), r["n"].alias("n"), posterior(r["votes"], state["yes"], state["no"], state["prior"]).alias("p")))
        good = lambda s: (_total(F.transform(s, lambda x: x["n"] * x["p"])) + weight * prior) / (_total(F.transform(s, lambda x: x["n"])) + weight)
        new = let(seen, lambda s: F.struct(F.array(*[accuracy(j, s, 1, lambda p: p, yes) for j in range(voters)]).alias("yes"), F.array(*[accuracy(j, s, 0, lambda p: 1 - p, no) for j in range(voters)]).alias("no"), F.greatest(F.lit(0.01), F.least(F.lit(0.99), good(s))).alias("prior")))
        return let(new, lambda m: F.struct(m["yes"].alias("yes"), F.zip_with(m["yes"], m["no"], lambda y, n: F.greatest(n, 1 + EDGE - y)).alias("no"), m["prior"].alias("prior")))

    return rows.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("m")).select("m.*")


class Model(NamedTuple):
    """The few numbers of a fit."""

    yes: list[float]
    no: list[float]
    prior: float


def fitted(model: DataFrame) -> Model:
    row = model.first()
    return Model(list(row.yes), list(row.no), row.prior)


def probability(voters: list[Column], model: Model) -> Column:
    """Probability of yes for columns of votes, as one expression."""
    odds = [F.when(v == 1, log(y / (1 - n))).when(v == 0, log((1 - y) / n)).otherwise(0.0) for v, y, n in zip(voters, model.yes, model.no, strict=True)]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, odds, F.lit(log(model.prior / (1 - model.prior))))))
