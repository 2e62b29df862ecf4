"""Data products by name (X1): prepare, compute, publish. Rows in and out are counted while the product runs, by observations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

Inputs = dict[str, DataFrame]


@dataclass
class Product:
    """prepare(inputs, config) filters and shapes the inputs; compute(inputs, config) gives the result; publish(result) writes it, by
    one action over all of it."""

    name: str
    prepare: Callable[[Inputs, dict], Inputs]
    compute: Callable[[Inputs, dict], DataFrame]
    publish: Callable[[DataFrame], object]


@dataclass
class Run:
    """rows_in: rows of each prepared input, as often as compute reads it; rows_out: rows published."""

    name: str
    rows_in: dict[str, int]
    rows_out: int


@dataclass
class Registry:
    products: dict[str, Product] = field(default_factory=dict)

    def add(self, product: Product) -> None:
        if product.name in self.products:
            raise ValueError(f"{product.name} is there already")
        self.products[product.name] = product

    def run(self, name: str, inputs: Inputs, config: dict | None = None) -> Run:
        product, config = self.products[name], config or {}
        seen: dict[str, Observation] = {}

        def watched(what: str, df: DataFrame) -> DataFrame:
            seen[what] = Observation(f"{name}-{what}")
            return df.observe(seen[what], F.count(F.lit(1)).alias("rows"))

        prepared = {what: watched(f"in-{what}", df) for what, df in product.prepare(inputs, config).items()}
        product.publish(watched("out", product.compute(prepared, config)))
        return Run(name, {what: seen[f"in-{what}"].get["rows"] for what in prepared}, seen["out"].get["rows"])
