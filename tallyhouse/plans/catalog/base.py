"""The inputs a registered query works on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.features import clickstream_silver, engagement, financials_silver, risk
from tallyhouse.plans.loans import loan_silver
from tallyhouse.session import scratch_path
from tallyhouse.sources.views import view


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        """One of the shaped views."""
        return view(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @property
    def loan_silver(self) -> DataFrame:
        return loan_silver(self("loan_daily"))

    @property
    def clicks(self) -> DataFrame:
        return clickstream_silver(self("clickstream_raw"))

    @property
    def financials(self) -> DataFrame:
        return financials_silver(self("financials_raw"))

    @property
    def engagement(self) -> DataFrame:
        return engagement(self.clicks)

    @property
    def risk(self) -> DataFrame:
        return risk(self.financials)

    @property
    def raw(self) -> list[DataFrame]:
        return [self("clickstream_raw"), self("attributes_raw"), self("financials_raw")]
