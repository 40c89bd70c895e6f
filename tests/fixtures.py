"""Small raw feeds written by hand; every table is optional and defaults to empty."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql.types import StructType

from tidemart.plans.models import Models
from tidemart.settings import Settings
from tidemart.sources.schemas import RAW_SCHEMAS

SETTINGS = Settings(date(2026, 1, 1), date(2026, 12, 31), date(2026, 6, 30))

_DEFAULTS = {
    "financial_status": "paid",
    "currency": "USD",
    "status": "active",
    "quantity": 1,
}


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _value(field, row):
    value = row.get(field.name, _DEFAULTS.get(field.name))
    kind = field.dataType.simpleString()
    if value is None:
        return Decimal("0.00") if kind.startswith("decimal") and field.name not in row else None
    if kind.startswith("decimal"):
        return Decimal(str(value)).quantize(Decimal("0.01"))
    if kind.startswith("timestamp"):
        return at(value) if isinstance(value, str) else value
    if kind == "date":
        return date.fromisoformat(value) if isinstance(value, str) else value
    return value


def feed(spark, table, rows):
    schema = StructType.fromDDL(RAW_SCHEMAS[table])
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
    return spark.createDataFrame([tuple(_value(f, r) for f in schema) for r in rows], schema)


def models(spark, settings=SETTINGS, stored=None, **tables) -> Models:
    raw = {name: feed(spark, name, tables.get(name, [])) for name in RAW_SCHEMAS}
    return Models(spark, raw, settings, stored)


def order(order_id, customer_id, when, subtotal=100, **more):
    return {
        "order_id": order_id,
        "customer_id": customer_id,
        "created_at": when,
        "processed_at": when,
        "subtotal_price": subtotal,
        **more,
    }


def rows(df, *columns):
    """Rows as tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
