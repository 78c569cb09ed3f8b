"""Item documents: a JSON array of items per order, each with an array of garnishes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.schemas import GARNISH, ITEM, ITEMS, MONEY

# Repeated order ids are broadcast up to this many; at 36 characters each that is some 50 MB.
BROADCAST_IDS = 1_000_000


def infer_items_schema(df: DataFrame, column: str = "items") -> T.DataType:
    """Schema of a JSON text column, merged over all its values in one Spark aggregate.

    Opt-in: it reads the column once before the real work starts. Values that are not JSON are
    left out.
    """
    text = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("schema")).first()["schema"]
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def parse_items(df: DataFrame, schema: T.DataType = ITEMS, column: str = "items") -> DataFrame:
    """JSON text to `array<struct>`; malformed or null text gives null."""
    return df.withColumn(column, F.from_json(column, schema))


def malformed_items(df: DataFrame, schema: T.DataType = ITEMS, column: str = "items") -> DataFrame:
    """Rows whose text is present but does not parse."""
    return df.filter(F.col(column).isNotNull() & F.from_json(column, schema).isNull())


def _snake(name: str) -> str:
    return re.sub(r"(?<!^)([A-Z])", r"_\1", name).lower()


def _flat(struct: T.StructType, source: str, prefix: str = "", skip: str = "") -> list[Column]:
    """One column per scalar field and two per money field (`x` and `x_currency`)."""
    out = []
    for field in struct:
        if field.name == skip:
            continue
        path, name = f"{source}.{field.name}", prefix + _snake(field.name)
        if field.dataType == MONEY:
            out.append(F.col(f"{path}.value").alias(name))
            out.append(F.col(f"{path}.currency").alias(f"{name}_currency"))
        else:
            out.append(F.col(path).alias(name))
    return out


def _item_columns() -> list[Column]:
    return _flat(ITEM, "item", skip="garnishItems")


def _garnish_columns() -> list[Column]:
    return _flat(GARNISH, "garnish", prefix="garnish_")


def _distinct_array(array: Column | str) -> Column:
    # Sorting brings equal structs together; `array_distinct` compares all pairs of structs.
    # The sorted array is bound to a lambda variable, so that it is sorted once per row.
    def without_repeats(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(ordered, i - 1)))

    return F.transform(F.array(F.sort_array(array)), without_repeats)[0]


def _all_garnishes(items: str) -> Column:
    """Distinct garnishes over all items of an array."""
    lists = F.transform(items, lambda i: F.coalesce(i["garnishItems"], F.array()))
    return _distinct_array(F.flatten(lists))


def explode_items(parsed: DataFrame, outer: bool = False) -> DataFrame:
    """One row per item as `item`; an order without items drops out unless `outer` is set."""
    generator = F.explode_outer if outer else F.explode
    # An explode of the bare column makes Spark infer a filter on its size and push it below
    # the parsing, where the text would be parsed a second time.
    return parsed.withColumn("item", generator(F.transform("items", lambda i: i))).drop("items")


def _distinct_items(docs: DataFrame) -> DataFrame:
    """Distinct (order_id, item) over all documents."""
    return (
        parse_items(docs.select("order_id", "items"))
        .select("order_id", F.explode(_distinct_array("items")).alias("item"))
        .dropDuplicates()
    )


def _item_ids(items: DataFrame) -> DataFrame:
    # An id that one item holds twice counts once. Two items that differ only in their
    # garnishes stay two rows, although their columns are equal.
    ids = F.array_distinct("item.garnishItems.externalId")
    return items.withColumn("garnish_external_id", F.explode(ids))


def _items_apart(docs: DataFrame, one_document_per_order: bool, broadcast_ids: int) -> list[DataFrame]:
    """Distinct (order_id, item), in parts: orders with one document are told apart within the row, and only the
    items of orders with several are shuffled."""
    in_row = F.explode(_distinct_array("items")).alias("item")

    def apart(one: DataFrame) -> DataFrame:
        return parse_items(one.select("order_id", "items")).select("order_id", in_row)

    if one_document_per_order:
        return [apart(docs)]
    single, several = _split_by_documents(docs, broadcast_ids)
    return [apart(single)] if several is None else [apart(single), _distinct_items(several)]


def _split_by_documents(docs: DataFrame, broadcast_ids: int) -> tuple[DataFrame, DataFrame | None]:
    """Documents of orders that have one, and of all others; documents without an order id are one order's."""
    docs = docs.select("order_id", "items")
    repeated = docs.groupBy("order_id").count().filter("count > 1").select(F.col("order_id").alias("__repeated"))
    ids = repeated.count()
    if ids == 0:
        return docs, None
    known = F.broadcast(repeated) if ids <= broadcast_ids else repeated
    of_several = F.col("order_id").eqNullSafe(F.col("__repeated"))
    return docs.join(known, of_several, "left_anti"), docs.join(known, of_several, "left_semi")


def _union(parts: list[DataFrame]) -> DataFrame:
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def item_detail(
    docs: DataFrame, one_document_per_order: bool = False, broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """One row per item and garnish id, with the item's columns and its garnish array.

    Items repeat across the documents of an order, if it has several; those orders are found by a count over the
    ids alone, which is a job of its own, and only their items are shuffled. A caller who knows that there are
    none says so and saves it.
    """
    parts = _items_apart(docs, one_document_per_order, broadcast_ids)
    return _item_ids(_union(parts)).select(
        "order_id",
        *_item_columns(),
        "garnish_external_id",
        F.col("item.garnishItems").alias("garnish_items"),
    )


def garnish_detail(
    docs: DataFrame, one_document_per_order: bool = False, broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """Distinct garnishes of each order. Each array is read once per item, not once per id; as in `item_detail`,
    only garnishes of orders with several documents are shuffled."""

    def garnishes(some: DataFrame) -> DataFrame:
        parsed = parse_items(some.select("order_id", "items"))
        return parsed.select("order_id", F.explode(_all_garnishes("items")).alias("garnish")).select(
            "order_id", *_garnish_columns()
        )

    if one_document_per_order:
        return garnishes(docs)
    single, several = _split_by_documents(docs, broadcast_ids)
    return garnishes(single) if several is None else _union([garnishes(single), garnishes(several).dropDuplicates()])


def _match_in_row(docs: DataFrame, per_item: bool) -> DataFrame:
    """`order_items` for orders with a single document: no shuffle, no join."""
    parsed = parse_items(docs)
    pool = F.lit(None) if per_item else _all_garnishes("items")
    items = parsed.select("order_id", "items", pool.alias("pool")).select(
        "order_id", F.explode(_distinct_array("items")).alias("item"), "pool"
    )
    if per_item:
        own = _distinct_array("item.garnishItems")
        matched = F.filter(own, lambda g: g["externalId"].isNotNull())
    else:
        ids = F.col("item.garnishItems.externalId")
        matched = F.filter("pool", lambda g: F.array_contains(ids, g["externalId"]))
    return items.select("order_id", "item", F.explode(matched).alias("garnish")).select(
        "order_id", *_item_columns(), *_garnish_columns()
    )


def _marked_garnishes(garnishes: str) -> Column:
    """Garnishes that have an id, each as (`first`, `garnish`): `first` marks one of those that share an id."""

    def marked(ordered: Column) -> Column:
        def entry(x: Column, i: Column) -> Column:
            first = (i == 0) | (x["id"] != F.get(ordered, i - 1)["id"])
            return F.struct(first.alias("first"), x["garnish"].alias("garnish"))

        return F.transform(ordered, entry)

    known = F.filter(garnishes, lambda g: g["externalId"].isNotNull())
    by_id = F.transform(known, lambda g: F.struct(g["externalId"].alias("id"), g.alias("garnish")))
    return F.transform(F.array(F.sort_array(by_id)), marked)[0]


def _match_by_join(docs: DataFrame, per_item: bool, broadcast_ids: int | None = None) -> DataFrame:
    """`order_items` by a join on order and garnish id. Without `broadcast_ids` all orders have several documents.

    As in `item_detail`, items are shuffled to tell them apart only if their order has several documents. Then
    each garnish is shuffled once, by the keys of the join and with the columns of its item: the items
    that hold an id and the garnishes that have it are both read from there, and joined where they are. Of a hot
    order the ids are spread over the tasks; what shares one id is joined in one task, whose sorts may spill.
    """
    if per_item:
        own = F.explode(_distinct_array("item.garnishItems")).alias("garnish")
        return (
            _distinct_items(docs).select("order_id", "item", own)
            .filter("garnish.externalId IS NOT NULL")
            .select("order_id", *_item_columns(), *_garnish_columns())
        )
    items = _distinct_items(docs) if broadcast_ids is None else _union(_items_apart(docs, False, broadcast_ids))
    marked = F.explode(_marked_garnishes("item.garnishItems")).alias("marked")
    flat = (
        items.select("order_id", "item", marked)
        .select("order_id", "item", "marked.first", "marked.garnish")
        .select("order_id", "first", *_item_columns(), *_garnish_columns())
    )
    keys, columns = ["order_id", "garnish_external_id"], [c for c in flat.columns if c != "first"]
    item_columns = [c for c in columns if not c.startswith("garnish_")]
    # Behind an array no column is pruned, which would make two shuffles of one.
    met = F.array(F.struct(*[c for c in flat.columns if c not in keys])).alias("met")
    shuffled = flat.select(*keys, met).repartition(*keys)
    apart = shuffled.select(*keys, F.inline(F.transform("met", lambda m: m)))
    # Two items that differ only in their garnishes stay two rows, although their columns are equal.
    holding = apart.filter("first").select("garnish_external_id", *item_columns)
    garnishes = apart.drop("first", *item_columns[1:]).dropDuplicates()
    return holding.join(garnishes, keys).select(*columns)


def _split_repeated(docs: DataFrame, broadcast_ids: int) -> tuple[DataFrame, DataFrame | None]:
    """Orders with one document, and the documents of all other orders."""
    repeated = docs.groupBy("order_id").count().filter("count > 1").select("order_id")
    ids = repeated.count()
    if ids == 0:
        return docs, None
    if ids <= broadcast_ids:
        known = F.broadcast(repeated)
        return docs.join(known, "order_id", "left_anti"), docs.join(known, "order_id", "left_semi")
    # Many repeats are mostly copies, as in a table read over all its days. The least and the
    # greatest text of an order tell copies from different documents in one shuffle.
    ends = docs.groupBy("order_id").agg(
        F.min("items").alias("least"), F.max("items").alias("items")
    )
    single = ends.filter("least = items").select("order_id", "items")
    several = ends.filter("least != items").select("order_id")
    return single, docs.join(several, "order_id", "left_semi")


def order_items(
    orders: DataFrame,
    per_item: bool = False,
    one_document_per_order: bool = False,
    broadcast_ids: int = BROADCAST_IDS,
    always_join: bool = False,
) -> DataFrame:
    """Item columns joined with garnish columns on (order, garnish id).

    By default an item meets every garnish of its *order* that has one of its garnish ids, also
    those that hang on another item; `per_item=True` keeps to the item's own garnishes. Orders
    may repeat, with equal or different documents: all of an order's documents count as one.

    An order with one document is matched inside its row, without a shuffle; that work grows with
    the square of the garnishes in the document. Orders that repeat are found first by a count
    over the ids alone, and matched by a join. The count is a job of its own; a caller who knows
    that the ids are unique says so and saves it.
    """
    docs = orders.select("order_id", "items").filter("order_id IS NOT NULL")
    if always_join:
        return _match_by_join(docs, per_item, broadcast_ids)
    if one_document_per_order:
        return _match_in_row(docs, per_item)
    single, rest = _split_repeated(docs, broadcast_ids)
    matched = _match_in_row(single, per_item)
    return matched if rest is None else matched.unionByName(_match_by_join(rest, per_item))


def items_wide(orders: DataFrame) -> DataFrame:
    """One row per order with an array per item field and an array of arrays per garnish field."""
    item_arrays, garnish_arrays = [], []
    for field in ITEM:
        if field.name == "garnishItems":
            continue
        name = _snake(field.name)
        path = f"items.{field.name}"
        if field.dataType == MONEY:
            item_arrays.append(F.col(f"{path}.value").alias(name))
            item_arrays.append(F.col(f"{path}.currency").alias(f"{name}_currency"))
        else:
            item_arrays.append(F.col(path).alias(name))
    for field in GARNISH:
        name = f"garnish_items_{_snake(field.name)}"
        if field.dataType == MONEY:
            for part, suffix in (("value", ""), ("currency", "_currency")):
                garnish_arrays.append(_garnish_field(field.name, part).alias(name + suffix))
        else:
            garnish_arrays.append(_garnish_field(field.name).alias(name))
    return parse_items(orders.select("order_id", "items")).select(
        "order_id", *item_arrays, *garnish_arrays
    )


def _garnish_field(name: str, part: str | None = None) -> Column:
    def field(item: Column) -> Column:
        values = item["garnishItems"][name]
        return values[part] if part else values

    return F.transform("items", field)
