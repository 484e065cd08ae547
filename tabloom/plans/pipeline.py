"""Named steps over tables: chains of transforms, and rollups built from prior tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators.layout import swap

Step = Callable[[DataFrame], DataFrame]


def chain(*steps: Step) -> Step:
    """Steps from left to right as one."""
    return lambda df: reduce(lambda d, f: d.transform(f), steps, df)


@dataclass
class Rollup:
    """A table made from others: inputs that are missing are None unless they are required."""

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    required: tuple[str, ...] = ()
    order: list = field(default_factory=list)
    least_ratio: float = 0.5
    least_rows: int = 0

    def run(self, spark: SparkSession, base: str) -> int:
        """Read the inputs below base, build, and swap the result in; returns its rows."""
        from tabloom.operators.layout import exists

        tables = {}
        for name in self.inputs:
            there = exists(spark, f"{base}/{name}.parquet")
            if not there and name in self.required:
                raise FileNotFoundError(f"{base}/{name}.parquet")
            tables[name] = spark.read.parquet(f"{base}/{name}.parquet") if there else None
        return swap(self.build(**tables), f"{base}/{self.name}.parquet", self.order or None, self.least_ratio, self.least_rows)


def run_all(spark: SparkSession, base: str, rollups: list[Rollup]) -> dict[str, int | str]:
    """Run rollups in order; one that fails doesn't stop the others."""
    out: dict[str, int | str] = {}
    for r in rollups:
        try:
            out[r.name] = r.run(spark, base)
        except Exception as e:  # reported, not hidden
            out[r.name] = f"failed: {e}"
    return out
