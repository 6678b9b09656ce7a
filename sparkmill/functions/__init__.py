"""Column functions of the match graph, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def inverse_frequency(n: Column, df: Column) -> Column:
    """Weight of a word that df of n images have; over 0 even for one that all have."""
    return F.log(1 + n / df)


def unit_weight(weight: Column, image: str) -> Column:
    """The weight as a part of the length of its image's vector."""
    return weight / F.sqrt(F.sum(weight * weight).over(Window.partitionBy(image)))


def least_of(*columns: str) -> list[Column]:
    """An unordered pair of columns in ascending order."""
    return [F.least(*columns), F.greatest(*columns)]
