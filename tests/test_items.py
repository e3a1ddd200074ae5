"""Item texts as VARIANT: the rows of the typed form, unknown fields, and what gives no row."""

import pytest
from conftest import dicts

from lakeline.plans import items, staging

# Fields in the order in which VARIANT gives them back.
ITEM = '{"item_id":"a","name":"n","note":"x","price_vnd":1,"quantity":"2","tags":["p",1]}'
COLUMNS = ("item_id", "item_name", "price_vnd", "quantity", "line_total_vnd")

SAME = [
    None, "", "[]", "  ", "[{bad", '{"item_id":"a"}', f"[{ITEM}]", f"\n\t [{ITEM}]",
    f"[{ITEM}", f"[null,{ITEM}]", f"[[{ITEM}]]", '["s"]', "5", "null",
    '[{"item_id":5,"name":7,"price_vnd":15,"quantity":null}]',
    '[{"item_id":{"x":1},"name":[1,2],"price_vnd":3,"quantity":"007"}]',
    '[{"item_id":"","name":"x"},{"name":"x"},{"item_id":null}]', f"[{ITEM},{ITEM}]",
]


@pytest.mark.parametrize("lenient", [False, True])
def test_variant_items_equal_the_typed_ones(rows, lenient):
    raw = rows.orders(*({"order_id": str(i), "items": t} for i, t in enumerate(SAME)))
    keep = ["order_id", "city", "placed_date", *COLUMNS]
    typed = staging.stg_order_items(raw, lenient=lenient).select(*keep)
    variant = items.stg_order_items_variant(raw, lenient=lenient).select(*keep)
    found = sorted(map(str, variant.collect()))
    assert found == sorted(map(str, typed.collect())) and len(found) == 7
    assert dict(variant.dtypes) == dict(typed.dtypes)


def test_unknown_fields_are_kept_as_they_came(rows):
    plain = '{"item_id":"b","name":"n","price_vnd":1,"quantity":1}'
    out = items.stg_order_items_variant(rows.orders({"items": f"[{ITEM},{plain}]"}))
    assert {r["item_id"]: r["extra"] for r in dicts(out)} == {
        "a": '{"note":"x","tags":["p",1]}', "b": None}


def test_shapes_that_the_typed_form_loses_or_reads_otherwise(rows):
    texts = [f"[1,{ITEM}]", '[{"item_id":1.0}]', '[{"item_id":"a","item_id":"b"}]']
    raw = rows.orders(*({"order_id": str(i), "items": t} for i, t in enumerate(texts)))
    typed = {(r["order_id"], r["item_id"]) for r in dicts(staging.stg_order_items(raw))}
    variant = {(r["order_id"], r["item_id"]) for r in dicts(items.stg_order_items_variant(raw))}
    assert typed == {("1", "1.0"), ("2", "b")}
    assert variant == {("0", "a"), ("1", "1")}
    assert {(r["order_id"], r["reason"]) for r in dicts(items.item_rejects(raw))} == {
        ("0", "no item_id"), ("2", "unreadable")}


def test_unreadable_number_fails_or_becomes_null(rows):
    raw = rows.orders({"items": '[{"item_id":"a","price_vnd":1.5,"quantity":1}]'})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        items.stg_order_items_variant(raw).collect()
    assert dicts(items.stg_order_items_variant(raw, lenient=True))[0]["price_vnd"] is None


def test_replayed_orders_repeat_unless_deduplicated(rows):
    raw = rows.orders({"items": f"[{ITEM}]"}, {"items": f"[{ITEM}]"})
    assert items.stg_order_items_variant(raw).count() == 2
    assert items.stg_order_items_variant(raw, dedup=True).count() == 1


def test_every_text_ends_in_rows_or_in_rejects(rows):
    raw = rows.orders(*({"order_id": str(i), "items": t} for i, t in enumerate(SAME)))
    rejects = sorted((r["order_id"], r["reason"], r["record"]) for r in dicts(items.item_rejects(raw)))
    assert rejects == sorted([
        ("4", "unreadable", "[{bad"), ("5", "no array", '{"item_id":"a"}'),
        ("8", "unreadable", f"[{ITEM}"), ("9", "no item_id", "null"),
        ("10", "no item_id", f"[{ITEM}]"), ("11", "no item_id", '"s"'),
        ("12", "no array", "5"), ("13", "no array", "null"),
        ("16", "no item_id", '{"item_id":"","name":"x"}'), ("16", "no item_id", '{"name":"x"}'),
        ("16", "no item_id", '{"item_id":null}'),
    ])


def test_item_texts_are_parsed_once(rows):
    plan = items.stg_order_items_variant(rows.orders({"items": f"[{ITEM}]"}))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson(") == 1 and "Exchange" not in text
