"""Item documents as JSON text, made a batch of orders at a time over Arrow columns."""

from __future__ import annotations

import json
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What the lines of an item, and those of a garnish that are not returned, add up to.
ITEM_SUMS = {
    "n": "sum", "quantity": "sum", "partkey": "min", "greatest_status": "max", "tax": "sum", "discount": "sum",
    "unit": "max", "price": "sum", "returned": "sum",
}
GARNISH_SUMS = {
    "number": "min", "item": "min", "p_name": "min", "quantity": "sum", "suppkey": "min", "partkey": "min",
    "flag": "min", "least_status": "min", "tax": "sum", "discount": "sum", "retail": "min", "price": "sum",
}


def _double(x: float) -> str:
    """A double as Spark's JSON writer has it."""
    if not math.isfinite(x):
        return '"NaN"' if math.isnan(x) else '"Infinity"' if x > 0 else '"-Infinity"'
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
    shown = "".join(map(str, digits))
    return f"{'-' * sign}{shown[0]}.{shown[1:] or '0'}E{len(shown) - 1 + exponent}"


def _each(values: pa.Array, shown) -> pa.Array:
    """`shown` of every value, worked out once for each distinct one; null stays null."""
    kinds = values.dictionary_encode()
    return pa.array([shown(x) for x in kinds.dictionary.to_pylist()], pa.string()).take(kinds.indices)


def _quoted(values: pa.Array) -> pa.Array:
    return _each(values, lambda text: json.dumps(text, ensure_ascii=False))


def _field(name: str, value: pa.Array, before: str = "", after: str = "") -> pa.Array:
    return pc.binary_join_element_wise(f'"{name}":{before}', value, after, "")


def _number(name: str, value: pa.Array) -> pa.Array:
    return _field(name, value.cast(pa.string()), '"', '"')


def _money(name: str, value: pa.Array) -> pa.Array:
    known = _field(name, value.cast(pa.string()), '{"value":"', '","currency":"USD"}')
    return known if not known.null_count else known.fill_null(f'"{name}":{{"currency":"USD"}}')


def _object(*fields: pa.Array | str) -> pa.Array:
    """Fields that are null are left out, as Spark's JSON writer does."""
    inner = pc.binary_join_element_wise(*fields, ",", null_handling="skip")
    return pc.binary_join_element_wise("{", inner, "}", "")


def _lists(texts: pa.Array, of: np.ndarray, size: int) -> pa.Array:
    """The texts of each of `size` owners, named in order by `of`, as a JSON array."""
    ends = np.cumsum(np.bincount(of, minlength=size))
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), texts)
    return pc.binary_join_element_wise("[", pc.binary_join(listed, ","), "]", "")


def _changes(values: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; nulls are equal."""
    codes = values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.concatenate([[True], codes[1:] != codes[:-1]])


def _summed(columns: dict[str, pa.Array], run: np.ndarray, sums: dict[str, str]) -> dict[str, pa.Array]:
    rows = pa.table({"run": run} | {c: columns[c] for c in sums})
    found = rows.group_by("run", use_threads=False).aggregate(list(sums.items())).sort_by("run").combine_chunks()
    return {c: pa.concat_arrays(found[f"{c}_{f}"].chunks) for c, f in sums.items()}


def documents(lines: pa.Array) -> pa.Array:
    """The document of each order, given its lines as a sorted array of structs: an item per name, and in it a
    garnish per number of lines that are not known to be returned."""
    sizes = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
    flat = lines.flatten()
    if not len(flat):
        return pa.array(["[]"] * len(lines), pa.string())
    columns = dict(zip([f.name for f in flat.type], flat.flatten(), strict=True))
    order = np.repeat(np.arange(len(lines)), sizes)
    new_item = np.concatenate([[True], order[1:] != order[:-1]]) | _changes(columns["name"])
    item = np.cumsum(new_item) - 1
    garnish = np.cumsum(new_item | _changes(columns["number"])) - 1
    kept, zero = columns["kept"], pa.scalar(0, pa.int64())
    columns["returned"] = pc.if_else(pc.fill_null(kept, True), zero, columns["n"])
    columns["item"] = pa.array(item)

    some = pc.fill_null(kept, True)
    shown = {c: columns[c].filter(some) for c in GARNISH_SUMS}
    if kept.null_count:
        # A line that may be returned shows its number, and adds nothing.
        counts = pc.fill_null(kept, False).filter(some)
        for c in set(GARNISH_SUMS) - {"number", "item"}:
            shown[c] = pc.if_else(counts, shown[c], pa.scalar(None, shown[c].type))
    starts = np.flatnonzero(new_item)
    texts, of = pa.array([], pa.string()), np.zeros(0, np.int64)
    if len(shown["item"]):
        g = _summed(shown, garnish[some.to_numpy(zero_copy_only=False)], GARNISH_SUMS)
        of = g["item"].to_numpy()
        texts = _object(
            _field("name", _quoted(g["p_name"])),
            _field("quantity", _each(g["quantity"], _double)),
            _field("sequence", g["number"].cast(pa.string())),
            _number("externalId", g["suppkey"]),
            _number("integrationId", g["partkey"]),
            _field("categoryId", _quoted(g["flag"])),
            _field("categoryName", _quoted(g["least_status"])),
            _money("addition", g["tax"]),
            _money("discount", g["discount"]),
            _money("unitPrice", g["retail"]),
            _money("totalValue", g["price"]),
        )
    i = _summed(columns, item, ITEM_SUMS)
    note = pc.if_else(pc.greater(i["n"], 1), i["greatest_status"], pa.scalar(None, pa.string()))
    items = _object(
        _field("name", _quoted(columns["name"].take(pa.array(starts)))),
        _field("quantity", _each(i["quantity"], _double)),
        _number("externalId", i["partkey"]),
        '"integrationId":"0"',
        _field("customerNote", _quoted(note)),
        _money("addition", i["n"]),
        _money("discount", i["discount"]),
        _money("unitPrice", i["unit"]),
        _money("totalValue", i["price"]),
        _money("totalAddition", i["tax"]),
        _money("totalDiscount", i["returned"]),
        _field("garnishItems", _lists(texts, of, len(starts))),
    )
    return _lists(items, order[starts], len(lines))
