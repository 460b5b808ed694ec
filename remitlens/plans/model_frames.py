"""Lazy frames of the transfer model for one scale-factor directory."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from remitlens.operators import facts
from remitlens.sources import model


class Frames:
    """users / accounts / tx / etx / geo / fact as lazy DataFrames (no actions).

    Made anew for every query, so files that were added since are read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return model.table(self.spark, self.sf_dir, name)

    @cached_property
    def users(self) -> DataFrame:
        return model.users(self.spark, self.sf_dir)

    @cached_property
    def accounts(self) -> DataFrame:
        return model.accounts(self.spark, self.sf_dir)

    @cached_property
    def tx(self) -> DataFrame:
        return model.tx(self.spark, self.sf_dir)

    @cached_property
    def etx(self) -> DataFrame:
        return model.etx(self.spark, self.sf_dir)

    @cached_property
    def geo(self) -> DataFrame:
        return facts.export_join(self.etx, self.users)

    @cached_property
    def tx_geo(self) -> DataFrame:
        return facts.export_join(self.tx, self.users)

    def _fact(self, transfers: DataFrame) -> DataFrame:
        geo = facts.export_join(transfers, facts.normalized_places(self.users))
        return facts.fact_geo_explode(geo, normalize_locations=False)

    @cached_property
    def fact(self) -> DataFrame:
        return self._fact(self.etx)

    @cached_property
    def tx_fact(self) -> DataFrame:
        """History transfers exploded the same way (years 1995..2001)."""
        return self._fact(self.tx)

    @cached_property
    def tx_sides(self) -> DataFrame:
        from remitlens.operators import history
        return history.transfer_sides(self.tx, self.accounts)

    @cached_property
    def tx_parts(self) -> DataFrame:
        from remitlens.operators import history
        return history.participants(self.tx_sides)
