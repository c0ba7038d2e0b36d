"""PRJ1-4: staging casts. Lazy projections, fused into the readers by Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.sources import schemas


def _cast(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stg_accounts(raw: DataFrame) -> DataFrame:
    return _cast(raw, schemas.ACCOUNTS)


def stg_product_events(raw: DataFrame) -> DataFrame:
    return _cast(raw, schemas.PRODUCT_EVENTS)


def stg_billing_events(raw: DataFrame) -> DataFrame:
    return _cast(raw, schemas.BILLING_EVENTS)


def stg_support_tickets(raw: DataFrame) -> DataFrame:
    return _cast(raw, schemas.SUPPORT_TICKETS)


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "accounts": stg_accounts(raw["accounts"]),
        "product_events": stg_product_events(raw["product_events"]),
        "billing_events": stg_billing_events(raw["billing_events"]),
        "support_tickets": stg_support_tickets(raw["support_tickets"]),
    }
