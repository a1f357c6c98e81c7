"""Search inside the raw JSON payload: containment and promoted fields."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def payload_variant(payload: Column) -> Column:
    """The payload as VARIANT; of a repeated key the last value counts (see ``session.use_utc``)."""
    return F.try_parse_json(payload)


def contains(variant: Column, pattern) -> Column:
    """Does the document contain ``pattern`` (a dict, list or scalar)?

    An object contains another one if it has all its keys with containing values; an array
    contains another one if each wanted element is contained in some element. Types count:
    ``"443"`` is not ``443``. The pattern is turned into one Boolean column, with a path from
    the document's top for every value asked for.
    """
    found = _matches(variant, "$", pattern)
    if not isinstance(pattern, (dict, list)):
        # At the top only, an array also contains a scalar that is one of its elements.
        found = F.coalesce(found, F.lit(False)) | _any(variant, "$", pattern)
    return F.coalesce(found, F.lit(False))


def payload_contains(packets: DataFrame, pattern, payload: str = "payload") -> DataFrame:
    """Packets whose payload contains ``pattern``.

    The parsed payload passes through ``explode(array(..))``, so that it is parsed once and
    not anew for every value of the pattern.
    """
    return (
        packets.withColumn("_variant", F.explode(F.array(payload_variant(F.col(payload)))))
        .filter(contains(F.col("_variant"), pattern))
        .drop("_variant")
    )


def _matches(variant: Column, path: str, pattern) -> Column:
    if isinstance(pattern, dict) and pattern:
        # A path through a key is only there in an object, so objects need no check of their own.
        return reduce(and_, [_matches(variant, _step(path, k), v) for k, v in pattern.items()])
    if isinstance(pattern, list) and pattern:
        return reduce(and_, [_any(variant, path, wanted) for wanted in pattern])
    kind = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
    if isinstance(pattern, dict):
        return kind.startswith("OBJECT")
    if isinstance(pattern, list):
        return kind.startswith("ARRAY")
    if pattern is None:
        return F.is_variant_null(F.try_variant_get(variant, path, "variant"))
    if isinstance(pattern, bool):
        name, kinds, value = "boolean", "^BOOLEAN", F.lit(pattern)
    elif isinstance(pattern, int):
        name, kinds = "decimal(38,9)", "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
        value = F.lit(pattern).cast(name)
    elif isinstance(pattern, float):
        name, kinds, value = "double", "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", F.lit(pattern)
    else:
        name, kinds, value = "string", "^STRING", F.lit(pattern)
    # The value first: it is seldom equal, and then its kind need not be found out.
    return (F.try_variant_get(variant, path, name) == value) & kind.rlike(kinds)


def _any(variant: Column, path: str, wanted) -> Column:
    elements = F.try_variant_get(variant, path, "array<variant>")
    kind = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
    return kind.startswith("ARRAY") & F.coalesce(
        F.exists(elements, lambda element: _matches(element, "$", wanted)), F.lit(False)
    )


def _step(path: str, key: str) -> str:
    if "'" not in key:
        return f"{path}['{key}']"
    if '"' not in key:
        return f'{path}["{key}"]'
    raise ValueError(f"a key with both kinds of quotes cannot be used in a path: {key!r}")


def promoted(payload: Column, fields: dict[str, tuple[str, ...]]) -> Column:
    """A struct of text columns taken from nested keys, in one pass over the text.

    ``fields`` maps a column name to its key path. Only the wanted keys are in the parse
    schema, so every other part of the document is skipped, not materialised.
    """
    parsed = F.from_json(payload, _ddl(_tree(fields)))

    def pick(document: Column) -> Column:
        columns = []
        for name, path in fields.items():
            value = document
            for key in path:
                value = value[key]
            columns.append(value.alias(name))
        return F.struct(*columns)

    return F.element_at(F.transform(F.array(parsed), pick), 1)


def _tree(fields: dict[str, tuple[str, ...]]) -> dict:
    tree: dict = {}
    for path in fields.values():
        node = tree
        for key in path[:-1]:
            node = node.setdefault(key, {})
        node.setdefault(path[-1], None)
    return tree


def _ddl(tree: dict) -> str:
    parts = [f"`{k}`: {'STRING' if v is None else _ddl(v)}" for k, v in tree.items()]
    return f"STRUCT<{', '.join(parts)}>"
