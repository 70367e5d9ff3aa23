"""Entities of one input directory, built lazily for a session."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..schema import RunParams
from ..session import tune
from ..sources import adapters, metadata

# Parameters of the registered queries (the reference's request parameters).
DEFAULT_PARAMS = RunParams(
    start_date="1996/01/01 00:00:00",
    end_date="1998/12/31 00:00:00",
    only_unsent="N",
    lang="US",
    as_of="2014/04/25 09:09:17",
)


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT_PARAMS):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self.params = params

    @cached_property
    def checks(self) -> DataFrame:
        return adapters.checks(self.spark, self.sf_dir)

    @cached_property
    def sites(self) -> DataFrame:
        return adapters.supplier_sites(self.spark, self.sf_dir)

    @cached_property
    def invoice_payments(self) -> DataFrame:
        return adapters.invoice_payments(self.spark, self.sf_dir)

    @cached_property
    def invoices(self) -> DataFrame:
        return adapters.invoices(self.spark, self.sf_dir)

    @cached_property
    def docs(self) -> DataFrame:
        return adapters.payment_documents(self.spark, self.sf_dir)

    @cached_property
    def values(self) -> DataFrame:
        return metadata.value_sets(self.spark)

    @cached_property
    def formats(self) -> DataFrame:
        return metadata.formats(self.spark)

    @cached_property
    def fields(self) -> DataFrame:
        return metadata.format_fields(self.spark)

    def bank_tables(self) -> dict[str, DataFrame]:
        s, d = self.spark, self.sf_dir
        return dict(uses=adapters.bank_acct_uses(s, d), accounts=adapters.bank_accounts(s, d),
                    banks=adapters.banks(s, d), units=adapters.operating_units(s, d),
                    entities=adapters.legal_entities(s, d))
