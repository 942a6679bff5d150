"""Decay and engagement scores."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from hubbub.functions.times import MS_PER_HOUR, elapsed_ms


@dataclass(frozen=True)
class Weights:
    """Linear weights of the four engagement counts."""

    like: float = 1.0
    comment: float = 1.0
    recast: float = 1.0
    quote: float = 1.0


def age_score(updated_at: Column, as_of: Column, half_life_hours: float = 24.0) -> Column:
    """Exponential decay that halves every ``half_life_hours``."""
    hours = elapsed_ms(as_of, updated_at) / F.lit(MS_PER_HOUR)
    return F.exp(hours * F.lit(-math.log(2) / half_life_hours))


def _weighted(count: Column, weight: float) -> Column:
    return F.coalesce(count * F.lit(float(weight)), F.lit(0.0))


def engagement_score(
    like: Column, comment: Column, recast: Column, quote: Column, weights: Weights = Weights()
) -> Column:
    """Weighted sum of the four counts; a missing count adds nothing."""
    return (
        _weighted(like, weights.like)
        + _weighted(comment, weights.comment)
        + _weighted(recast, weights.recast)
        + _weighted(quote, weights.quote)
    )


def engagement_score_without_likes(
    comment: Column, recast: Column, quote: Column, weights: Weights = Weights()
) -> Column:
    """The literal form some jobs run: likes left out and quotes counted twice."""
    return (
        _weighted(comment, weights.comment)
        + _weighted(recast, weights.recast)
        + _weighted(quote, weights.quote)
        + _weighted(quote, weights.quote)
    )


def half_even(value: Column, digits: int) -> Column:
    """Round half to even, as Python and pandas do."""
    return F.bround(value, digits)
