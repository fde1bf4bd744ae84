"""Document validation against a JSON-schema style rule set.

The schema is compiled once into Column expressions; each row gets a
``violations`` array with one entry per broken rule (``kind:path``). Nothing
leaves the executors and no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES: dict[str, tuple[type, ...]] = {
    "int": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "long": (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "double": (T.DoubleType, T.FloatType, T.DecimalType),
    "decimal": (T.DecimalType,),
    "string": (T.StringType, T.VarcharType, T.CharType),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "bool": (T.BooleanType,),
    "object": (T.StructType,),
    "array": (T.ArrayType,),
}


_KEYWORDS = {"bsonType", "enum", "required", "properties", "minItems", "items", "description"}


def _type_ok(dt: T.DataType, bson) -> bool:
    names = bson if isinstance(bson, (list, tuple)) else [bson]
    for n in names:
        if n not in _TYPES:
            raise ValueError(f"unsupported bsonType {n!r}")
        if isinstance(dt, _TYPES[n]):
            return True
    return False


def _field(dt: T.StructType, name: str) -> T.DataType | None:
    for f in dt.fields:
        if f.name == name:
            return f.dataType
    return None


def _rules(node: Column, dt: T.DataType | None, spec: Mapping, path: str) -> list[tuple[str, Column]]:
    unknown = set(spec) - _KEYWORDS
    if unknown:
        raise ValueError(f"unsupported rule keywords at {path}: {sorted(unknown)}")
    out: list[tuple[str, Column]] = []
    present = node.isNotNull()
    if "bsonType" in spec and dt is not None and not _type_ok(dt, spec["bsonType"]):
        out.append((f"type:{path}", present))
    if "enum" in spec:
        allowed = [F.lit(v) for v in spec["enum"]]
        out.append((f"enum:{path}", present & ~node.isin(*allowed)))
    if isinstance(dt, T.StructType):
        for req in spec.get("required", []):
            sub = f"{path}.{req}" if path else req
            child_dt = _field(dt, req)
            missing = F.lit(True) if child_dt is None else node[req].isNull()
            out.append((f"required:{sub}", (present & missing) if path else missing))
        for name, sub_spec in spec.get("properties", {}).items():
            child_dt = _field(dt, name)
            if child_dt is None:
                continue
            sub = f"{path}.{name}" if path else name
            for rn, rc in _rules(node[name], child_dt, sub_spec, sub):
                out.append((rn, (present & rc) if path else rc))
    if isinstance(dt, T.ArrayType):
        if "minItems" in spec:
            out.append((f"minItems:{path}", present & (F.size(node) < F.lit(spec["minItems"]))))
        items = spec.get("items")
        if items:
            elem_dt = dt.elementType
            # rule names come from a probe compile; each rule is then evaluated
            # inside a higher-order function over the elements
            item_rules = _rules(F.col("__x__"), elem_dt, items, f"{path}[]")
            for rn, _rc in item_rules:
                fn = _item_fn(elem_dt, items, rn, path)
                out.append((rn, present & F.coalesce(F.exists(node, fn), F.lit(False))))
    return out


def _item_fn(elem_dt, items, rule_name, path):
    def fn(x):
        for rn, rc in _rules(x, elem_dt, items, f"{path}[]"):
            if rn == rule_name:
                return rc
        return F.lit(False)

    return fn


def compile_schema(df_schema: T.StructType, schema: Mapping) -> list[tuple[str, Column]]:
    """(rule name, Column that is true when the rule is violated) for a frame schema."""
    unknown = set(schema) - {"bsonType", "required", "properties", "description"}
    if unknown:
        raise ValueError(f"unsupported rule keywords: {sorted(unknown)}")
    rules = []
    for req in schema.get("required", []):
        if _field(df_schema, req) is None:
            rules.append((f"required:{req}", F.lit(True)))
        else:
            rules.append((f"required:{req}", F.col(f"`{req}`").isNull()))
    for name, spec in schema.get("properties", {}).items():
        dt = _field(df_schema, name)
        if dt is None:
            continue
        rules.extend(_rules(F.col(f"`{name}`"), dt, spec, name))
    return rules


def validate(df: DataFrame, schema: Mapping, out: str = "violations") -> DataFrame:
    """Add ``violations``: array of broken rules (empty when the row is valid)."""
    rules = compile_schema(df.schema, schema)
    arr = F.array_compact(F.array(*[F.when(rc, F.lit(rn)) for rn, rc in rules])) if rules else F.array().cast(
        "array<string>"
    )
    return df.withColumn(out, arr)


# Kinds that ``schema_of_variant`` reports for the values of a JSON text.
_JSON_KINDS = {
    "int": r"BIGINT",
    "long": r"BIGINT",
    "double": r"(BIGINT|DOUBLE|DECIMAL.*)",
    "decimal": r"(BIGINT|DECIMAL.*)",
    "string": r"STRING",
    "bool": r"BOOLEAN",
    "object": r"OBJECT.*",
    "array": r"ARRAY.*",
}
_JSON_KEYWORDS = {"bsonType", "enum", "required", "properties", "description", "items", "minItems", "maxItems"}


def _json_rules(node: Column, spec: Mapping, path: Column | None = None) -> list[Column]:
    """Arrays of the rules that ``node`` breaks. ``path`` leads to it, None for the whole
    document; inside arrays it holds positions, so it is a value of the row."""
    unknown = set(spec) - _JSON_KEYWORDS
    if unknown:
        raise ValueError(f"unsupported rule keywords: {sorted(unknown)}")
    here = F.lit("$") if path is None else path
    kind, present = F.schema_of_variant(node), node.isNotNull() & ~F.is_variant_null(node)

    def child(name: str) -> tuple[Column, Column]:
        sub = F.lit(name) if path is None else F.concat(path, F.lit(f".{name}"))
        return F.try_variant_get(node, f"$['{name}']", "variant"), sub

    def broken(rule: str, condition: Column, at: Column = here) -> Column:
        return F.when(condition, F.array(F.concat(F.lit(f"{rule}:"), at)))

    out = []
    if "bsonType" in spec:
        names = spec["bsonType"] if isinstance(spec["bsonType"], (list, tuple)) else [spec["bsonType"]]
        bad = sorted(set(names) - set(_JSON_KINDS))
        if bad:
            raise ValueError(f"unsupported bsonType {bad}")
        kinds = "|".join(_JSON_KINDS[n] for n in names)
        out.append(broken("type", present & ~kind.rlike(f"^({kinds})$")))
    if "enum" in spec:
        # a value that is no text is left to the type rule
        text = F.when(kind == "STRING", F.try_variant_get(node, "$", "string"))
        out.append(broken("enum", F.coalesce(~text.isin(*spec["enum"]), F.lit(False))))
    for req in spec.get("required", []):
        value, sub = child(req)
        out.append(broken("required", present & kind.startswith("OBJECT") & (value.isNull() | F.is_variant_null(value)), sub))
    for name, child_spec in spec.get("properties", {}).items():
        out += _json_rules(child(name)[0], child_spec, child(name)[1])
    elements = F.when(kind.startswith("ARRAY"), F.try_variant_get(node, "$", "array<variant>"))
    if "minItems" in spec:
        out.append(broken("minItems", F.size(elements) < spec["minItems"]))
    if "maxItems" in spec:
        out.append(broken("maxItems", F.size(elements) > spec["maxItems"]))
    if "items" in spec:

        def of_element(x: Column, i: Column) -> Column:
            return _together(_json_rules(x, spec["items"], F.concat(here, F.lit("["), i.cast("string"), F.lit("]"))))

        out.append(F.flatten(F.transform(elements, of_element)))
    return out


def _together(checks: list[Column]) -> Column:
    none = F.array().cast("array<string>")
    return F.flatten(F.array(*[F.coalesce(c, none) for c in checks])) if checks else none


def validate_json(df: DataFrame, json_col: str, schema: Mapping, out: str = "violations") -> DataFrame:
    """Like ``validate`` for documents held as JSON text: types are those of each
    row's own values, not of a frame schema. Adds ``violations``; text that is no
    JSON breaks ``json:$``, a NULL text ``required:$``. Fields that are JSON null
    count as missing. Array items are checked one by one, arrays in arrays too, and
    named with their position from 0 (``type:lines[2].qty``)."""
    doc = F.col("__doc")
    checks = [
        F.when(F.col(json_col).isNull(), F.array(F.lit("required:$"))),
        F.when(F.col(json_col).isNotNull() & doc.isNull(), F.array(F.lit("json:$"))),
        *_json_rules(doc, schema),
    ]
    return df.withColumn("__doc", F.try_parse_json(json_col)).withColumn(out, _together(checks)).drop("__doc")


def validation_split(validated: DataFrame, col: str = "violations") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) — rejected rows keep their violation list (quarantine)."""
    ok = F.size(F.col(col)) == 0
    return validated.filter(ok), validated.filter(~ok)


def violation_counts(validated: DataFrame, col: str = "violations") -> DataFrame:
    """Rows per violated rule (partial aggregation before the shuffle)."""
    return validated.select(F.explode(col).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def parse_with_errors(df: DataFrame, parsers: Mapping[str, tuple[str, Column]], error_col: str = "error") -> DataFrame:
    """Row-level error capture without dropping rows.

    ``parsers``: output column -> (source column, parsed Column built with
    ``try_*`` functions). A row whose source is non-null but parses to NULL
    gets the failing column names in ``error_col``; good rows have NULL.
    """
    out = df.withColumns({name: parsed for name, (_, parsed) in parsers.items()})
    fails = [F.when(F.col(src).isNotNull() & F.col(name).isNull(), F.lit(name)) for name, (src, _) in parsers.items()]
    errs = F.array_compact(F.array(*fails))
    return out.withColumn(error_col, F.when(F.size(errs) > 0, F.array_join(errs, ",")))
