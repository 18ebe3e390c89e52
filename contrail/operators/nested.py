"""Nested data (N1, N2, P13): explode arrays of structs and flatten structs.

The flattener walks the schema once on the driver (metadata only) and emits a
single ``select``, so a struct of any depth becomes one projection in one
codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_paths(dt: T.DataType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Every leaf path under a struct type, depth first, in field order."""
    if isinstance(dt, T.StructType):
        out: list[tuple[str, ...]] = []
        for f in dt.fields:
            out.extend(leaf_paths(f.dataType, path + (f.name,)))
        return out
    return [path]


def flatten(df: DataFrame, col: str, prefix: str | None = None, sep: str = "_", drop: bool = True) -> DataFrame:
    """Replace struct column ``col`` by one column per leaf, named
    ``<prefix><sep><path joined by sep>`` (prefix defaults to ``col``)."""
    prefix = col if prefix is None else prefix
    dt = df.schema[col].dataType

    def q(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"
    # One SQL projection string per leaf: a single call builds the whole select.
    leaves = [f"{'.'.join(q(x) for x in (col, *p))} AS {q(sep.join((prefix, *p)) if prefix else sep.join(p))}"
              for p in leaf_paths(dt)]
    keep = [q(c) for c in df.columns if not (drop and c == col)]
    return df.selectExpr(*keep, *leaves)


def explode_flatten(df: DataFrame, col: str, outer: bool = False, prefix: str | None = None,
                    position: str | None = None) -> DataFrame:
    """N1 + N2: one row per array element, element struct flattened.

    ``outer=False`` drops rows with a NULL or empty array (``explode``);
    ``outer=True`` keeps them with NULL leaves. ``position`` keeps the element
    index. No shuffle: explode is a narrow generator.
    """
    pos = position or "__pos"
    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    # Always the outer generator, then drop the element-less rows for the inner
    # case: an inner explode makes Catalyst infer ``size(array) > 0`` and push
    # it below joins, so a computed array would be built twice per row.
    exploded = df.select(*others, F.posexplode_outer(F.col(col)).alias(pos, col))
    if not outer:
        exploded = exploded.where(F.col(pos).isNotNull())
    if not position:
        exploded = exploded.drop(pos)
    return flatten(exploded, col, prefix=prefix)
