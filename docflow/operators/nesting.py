"""Relational rows -> nested documents: column mapping, dotted-path nesting,
child folding, document assembly, unwind."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.exprs import col_


def rename_by_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by an upper-cased source-name lookup; unmapped columns are
    kept under their lower-case name. Target names may be dotted paths (they are
    kept as flat names here; see ``nest_by_path`` to build structs)."""
    upper = {k.upper(): v for k, v in mapping.items()}
    return df.select([F.col(f"`{c}`").alias(upper.get(c.upper(), c.lower())) for c in df.columns])


def _tree(mapping: Mapping[str, str | Column]) -> dict:
    root: dict = {}
    for path, src in mapping.items():
        node = root
        parts = path.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
            if not isinstance(node, dict):
                raise ValueError(f"path {path!r} conflicts with a scalar field")
        if parts[-1] in node:
            raise ValueError(f"duplicate target path {path!r}")
        node[parts[-1]] = src
    return root


def _build(node: dict) -> list[Column]:
    out = []
    for name, v in node.items():
        if isinstance(v, dict):
            out.append(F.struct(*_build(v)).alias(name))
        else:
            out.append(col_(v).alias(name))
    return out


def nest_by_path(df: DataFrame, mapping: Mapping[str, str | Column], keep: list[str] | None = None) -> DataFrame:
    """Build nested structs from ``{"target.dotted.path": source column}``.

    Any depth and any number of sub-documents; one projection, no shuffle.
    """
    cols = [F.col(c) for c in (keep or [])] + _build(_tree(mapping))
    return df.select(*cols)


def embed_child(
    parent: DataFrame, child: DataFrame, on: str | list[str], as_field: str, fields: list[str], how: str = "left"
) -> DataFrame:
    """Parent joined to (at most) one child row, child columns folded into a struct."""
    child_struct = child.select(*([on] if isinstance(on, str) else on), F.struct(*fields).alias(as_field))
    return parent.join(child_struct, on, how)


def collect_children(
    child: DataFrame, key: str, fields: Mapping[str, str | Column], as_field: str
) -> DataFrame:
    """Child rows -> one array of structs per parent key (sorted, deterministic).

    The grouping shuffles child rows on ``key``, and a parent is one row in one
    task: a parent holding a huge share of all children makes a huge document.
    That is the document model; where only the presence or the number of children
    matters, use ``flag_children`` or a plain aggregate instead.
    """
    s = F.struct(*[col_(c).alias(n) for n, c in fields.items()])
    return child.groupBy(key).agg(F.sort_array(F.collect_list(s)).alias(as_field))


def assemble_documents(
    main: DataFrame,
    key: str,
    children: Mapping[str, tuple[DataFrame, str, Mapping[str, str | Column]]],
) -> DataFrame:
    """Main rows + any number of child arrays, each attached by a left join.

    ``children``: field name -> (child frame, child key column, {struct field: source}).
    Parents without children get an empty array (not NULL).
    """
    out = main
    for field, (child, ckey, fields) in children.items():
        folded = collect_children(child.withColumnRenamed(ckey, key) if ckey != key else child, key, fields, field)
        out = out.join(folded, key, "left").withColumn(
            field, F.coalesce(F.col(field), F.array().cast(folded.schema[field].dataType))
        )
    return out


def flag_children(main: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Main rows + one boolean per kind of child: does the row have any?

    ``children``: flag name -> (child frame, child key column). Only distinct keys
    are joined (partial aggregation), so a hot parent is one row and no child
    array is built.
    """
    out = main
    for flag, (child, ckey) in children.items():
        keys = child.select(F.col(ckey).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
        out = out.join(keys, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out


def unwind(df: DataFrame, arr: str, as_field: str, keep_empty: bool = False) -> DataFrame:
    """One row per array element (``$unwind``); empty/missing arrays are dropped
    unless ``keep_empty``."""
    gen = F.explode_outer(arr) if keep_empty else F.explode(arr)
    return df.select(*[c for c in df.columns if c != arr], gen.alias(as_field))


def children_having_count(df: DataFrame, arr: str, pred, n: int, op: str = "==") -> DataFrame:
    """Parents whose array holds exactly (or op) ``n`` elements satisfying ``pred``.

    Counted inside the row (``size(filter(...))``): no unwind, no shuffle.
    """
    cnt = F.size(F.filter(F.coalesce(F.col(arr), F.array()), pred))
    ops = {"==": cnt == n, ">=": cnt >= n, ">": cnt > n, "<=": cnt <= n, "<": cnt < n}
    return df.withColumn("matching_children", cnt).filter(ops[op])


def array_field(arr: str | Column, field: str) -> Column:
    """Project one field of an array of structs into an array."""
    return F.transform(col_(arr), lambda x: x[field])


def first_element(arr: str | Column) -> Column:
    """First element or NULL for an empty/NULL array (no ANSI index error)."""
    return F.get(col_(arr), 0)


def required_fields(paths: list[str], arrays: Mapping[str, list[str]] | None = None) -> Column:
    """All scalar ``paths`` non-null, and for each array path: size > 0 and
    every element has the listed fields non-null."""
    preds = [F.col(p).isNotNull() for p in paths]
    for arr, fields in (arrays or {}).items():
        preds.append(F.coalesce(F.size(F.col(arr)) > 0, F.lit(False)))
        preds.append(
            F.coalesce(
                F.forall(F.col(arr), lambda x: (x.isNotNull() & F.lit(True)) if not fields else _all_nn(x, fields)),
                F.lit(False),
            )
        )
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def _all_nn(x: Column, fields: list[str]) -> Column:
    out = x.isNotNull()
    for f in fields:
        cur = x
        for part in f.split("."):
            cur = cur[part]
        out = out & cur.isNotNull()
    return out
