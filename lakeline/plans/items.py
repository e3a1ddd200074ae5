"""Order items read as VARIANT: fields of any shape, unknown ones kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import local_date
from ..operators.dedup import latest_by
from .staging import ORDER_TIES

#: The fields that the item model has columns for.
KNOWN = ("item_id", "name", "price_vnd", "quantity")


def _filled(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("items").isNotNull() & ~F.trim("items").isin("[]", ""))


def _elements(raw: DataFrame) -> DataFrame:
    """One row per element of the arrays; an object's fields carry a key, elements do not."""
    parsed = raw.withColumn("__items", F.try_parse_json("items"))
    exploded = raw.sparkSession.tvf.variant_explode(F.col("__items").outer())
    return parsed.lateralJoin(exploded).where(F.col("key").isNull())


def _field(name: str) -> Column:
    """A field as text: numbers and truth values in their JSON form, arrays and objects too."""
    return F.try_variant_get("value", f"$.{name}", "string")


def _unknown() -> Column:
    fields = F.try_variant_get("value", "$", "map<string,variant>")
    others = F.map_filter(fields, lambda name, _: ~name.isin(*KNOWN))
    return F.when(F.size(others) > 0, F.to_json(others))


def stg_order_items_variant(
    raw: DataFrame, dedup: bool = False, lenient: bool = False
) -> DataFrame:
    """``staging.stg_order_items`` with one more column, ``extra``: the fields of the item that
    the model does not know, as a JSON object (NULL if there is none).

    Rows and values are those of the typed form but for four shapes of text. An array that also
    has elements which are no objects keeps its items here, and loses all of them there. Decimal
    numbers lose zeros at their end (``1.0`` is the id ``1``). An object that names one field twice,
    and text that holds more than one JSON value, are no valid VARIANT: where Spark can't parse a
    text, no row comes from it and ``item_rejects`` lists it.
    """
    if dedup:
        ties = [c for c in ORDER_TIES if c in raw.columns]
        raw = latest_by(raw, ["order_id"], "event_timestamp", ties)

    def number(name: str) -> Column:
        return _field(name).try_cast("bigint") if lenient else _field(name).cast("bigint")

    return _elements(_filled(raw)).where(_field("item_id") != "").select(
        "order_id", "city", local_date("placed_at").alias("placed_date"),
        _field("item_id").alias("item_id"), _field("name").alias("item_name"),
        number("price_vnd").alias("price_vnd"), number("quantity").alias("quantity"),
        (number("price_vnd") * number("quantity")).alias("line_total_vnd"),
        _unknown().alias("extra"),
    )


def item_rejects(raw: DataFrame) -> DataFrame:
    """What of the item texts gives no row: (order_id, reason, record).

    ``unreadable`` texts and those that are ``no array`` come whole, of arrays the elements with
    ``no item_id``. NULL, blank and empty arrays are orders without items, not rejects.
    """
    parsed = _filled(raw).withColumn("__items", F.try_parse_json("items"))
    readable = F.col("__items").isNotNull()
    array = F.schema_of_variant("__items").startswith("ARRAY<")
    whole = parsed.where(~readable | ~array).select(
        "order_id", F.when(readable, "no array").otherwise("unreadable").alias("reason"),
        F.col("items").alias("record"))
    element = _elements(_filled(raw)).where(
        F.col("value").isNotNull() & (F.coalesce(_field("item_id"), F.lit("")) == ""))
    without_id = element.select(
        "order_id", F.lit("no item_id").alias("reason"), F.to_json("value").alias("record"))
    return whole.unionByName(without_id)
