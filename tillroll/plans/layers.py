"""All model layers of one star, as DataFrames and as named views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import models
from tillroll.sources.schemas import MART_SCHEMAS
from tillroll.sources.workspace import freed_shuffles, land

MARTS = list(MART_SCHEMAS)

MODELS = [
    "stg_sales",
    "stg_customers",
    "stg_products",
    "stg_countries",
    "int_sales_enriched",
    "int_order_metrics",
    "int_customer_orders",
    "int_customer_lifetime_value",
    "int_country_metrics",
    *MARTS,
]


class Layers:
    """The fourteen models over one star, each defined on first use."""

    def __init__(self, star: dict[str, DataFrame]) -> None:
        self._star = star

    @property
    def spark(self) -> SparkSession:
        return next(iter(self._star.values())).sparkSession

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(name)
        return getattr(self, name)

    def replaced(self, **tables: DataFrame) -> Layers:
        """The same models with some tables given; models built on them read these."""
        layers = Layers(self._star)
        layers.__dict__.update({n: t for n, t in self.__dict__.items() if n in getattr(self, "_given", ())})
        layers.__dict__.update(tables)
        layers.__dict__["_given"] = {*getattr(self, "_given", ()), *tables}
        return layers

    def stored(self, *names: str) -> Layers:
        """The same models with the named ones written once; models built on them read what was written."""
        layers = self
        for name in sorted(names, key=MODELS.index):
            layers = layers.replaced(**{name: land(layers[name], name)})
        return layers

    @cached_property
    def stg_sales(self) -> DataFrame:
        return models.stg_sales(self._star["fact_sales"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return models.stg_customers(self._star["dim_customer"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return models.stg_products(self._star["dim_product"])

    @cached_property
    def stg_countries(self) -> DataFrame:
        return models.stg_countries(self._star["dim_country"])

    @cached_property
    def int_sales_enriched(self) -> DataFrame:
        return models.int_sales_enriched(self.stg_sales, self.stg_products, self.stg_countries)

    @cached_property
    def int_order_metrics(self) -> DataFrame:
        return models.int_order_metrics(self.stg_sales)

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return models.int_customer_orders(self.stg_sales)

    @cached_property
    def int_customer_lifetime_value(self) -> DataFrame:
        return models.int_customer_lifetime_value(self.int_customer_orders)

    @cached_property
    def int_country_metrics(self) -> DataFrame:
        return models.int_country_metrics(self.stg_sales, self.stg_countries)

    @cached_property
    def mart_executive_kpis(self) -> DataFrame:
        return models.mart_executive_kpis(self.int_order_metrics, self.int_customer_orders)

    @cached_property
    def mart_customer_lifetime_value(self) -> DataFrame:
        return models.mart_customer_lifetime_value(self.int_customer_lifetime_value)

    @cached_property
    def mart_repeat_purchase_metrics(self) -> DataFrame:
        return models.mart_repeat_purchase_metrics(self.int_customer_orders)

    @cached_property
    def mart_country_revenue(self) -> DataFrame:
        return models.mart_country_revenue(self.int_country_metrics)

    @cached_property
    def mart_sales_monthly(self) -> DataFrame:
        return models.mart_sales_monthly(self.stg_sales)


def register_layers(
    spark: SparkSession, star: dict[str, DataFrame] | Layers, mart_schema: str | None = None
) -> Layers:
    """Publish every model as a temporary view under its name.

    With ``mart_schema`` the marts are also saved as tables of that schema,
    where ``export_marts`` reads them without computing them again. Layers with
    some models stored may be given in place of the star; the views then read these.
    """
    layers = star if isinstance(star, Layers) else Layers(star)
    for name in MODELS:
        layers[name].createOrReplaceTempView(name)
    if mart_schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {mart_schema}")
        with freed_shuffles(spark):
            for name in MARTS:
                layers[name].write.mode("overwrite").saveAsTable(f"{mart_schema}.{name}")
    return layers
