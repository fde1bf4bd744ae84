"""Shared Column builders. All JVM-side expressions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# MIME type -> file extension, as used by the title splitter.
MIME_EXTENSIONS = {
    "text/plain": "txt",
    "application/pdf": "pdf",
    "image/jpeg": "jpg",
    "application/vnd.ms-powerpoint": "pptx",
}

# Origination-system code -> display name for reports.
SYSTEM_ALIASES = {
    "ABC": "System ABC",
    "DEF": "System DEF",
    "GHI": "System GHI",
    "JKL": "System JKL",
    "MNO": "System MNO",
}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: Mapping) -> Column:
    """A literal MAP column (small, fixed-size lookup compiled into the plan)."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def lookup(mapping: Mapping, c: str | Column, keep_unknown: bool = False) -> Column:
    """Dictionary lookup; unknown keys give NULL, or the key itself if ``keep_unknown``."""
    found = F.element_at(map_literal(mapping), col_(c))
    return F.coalesce(found, col_(c)) if keep_unknown else found


def between_bounds(c: str | Column, lo, hi, bounds: str = "[)") -> Column:
    """Range predicate with explicit bound kinds: '()', '(]', '[)', '[]'.

    ``lo``/``hi`` may be None (open side). Typed literals keep the predicate pushable.
    """
    if bounds not in ("()", "(]", "[)", "[]"):
        raise ValueError(f"bounds must be one of (), (], [), []: {bounds!r}")
    c = col_(c)
    preds = []
    if lo is not None:
        lo_c = lo if isinstance(lo, Column) else F.lit(lo)
        preds.append(c >= lo_c if bounds[0] == "[" else c > lo_c)
    if hi is not None:
        hi_c = hi if isinstance(hi, Column) else F.lit(hi)
        preds.append(c <= hi_c if bounds[1] == "]" else c < hi_c)
    return reduce(lambda a, b: a & b, preds, F.lit(True)) if preds else F.lit(True)


def ts_lit(value: str) -> Column:
    """Zone-free timestamp literal (wall clock): independent of the session
    time zone and pushed down as-is against TIMESTAMP_NTZ columns."""
    return F.lit(value).cast("timestamp_ntz")


def wall_text(c: str | Column) -> Column:
    """A zone-free timestamp of whole seconds as 'yyyy-MM-dd HH:mm:ss'
    (``date_format`` would go through the session time zone)."""
    return col_(c).cast("timestamp_ntz").cast("string")


def wall_hour(c: str | Column, hours: int = 1) -> Column:
    """Start of the ``hours`` long part of the day (a divisor of 24) that holds
    ``c``, by the wall clock, in any session time zone; NULL stays NULL."""
    t = col_(c).cast("timestamp_ntz")
    part = F.floor(F.hour(t) / F.lit(hours)).cast("int") * hours
    return t.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), part)


def inclusive_end_date(c: str | Column, start_date: str, end_date: str) -> Column:
    """Calendar range with an inclusive end date: start <= ts < end + 1 day."""
    lo = ts_lit(start_date)
    hi = ts_lit(end_date) + F.expr("INTERVAL 1 DAY")
    return (col_(c) >= lo) & (col_(c) < hi)


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def optional_filter(values: Mapping[str, object], all_token: str = "ALL") -> Column:
    """Equality predicates where the value ``all_token`` (or None) disables the column."""
    return all_of(F.col(k) == F.lit(v) for k, v in values.items() if v is not None and v != all_token)


def elem_match(arr: str | Column, **conds) -> Column:
    """True when ONE element of an array of structs satisfies all conditions."""
    return F.exists(col_(arr), lambda x: all_of(x[k] == F.lit(v) for k, v in conds.items()))


def ne_or_missing(c: str | Column, value) -> Column:
    """Document ``$ne``: NULL / missing fields pass."""
    return ~col_(c).eqNullSafe(F.lit(value))


def ne_or_missing_array(arr: str | Column, value) -> Column:
    """``$ne`` on an array path: no element equals ``value`` (missing array passes)."""
    return ~F.coalesce(F.array_contains(col_(arr), F.lit(value)), F.lit(False))


def differing_fields(pairs: Mapping[str, tuple], null_safe: bool = True) -> Column:
    """Array of field names whose two sides differ.

    ``pairs`` maps name -> (left Column, right Column). NULL vs value is a
    difference when ``null_safe`` (default); NULL vs NULL is equal.
    """
    items = []
    for name, (a, b) in pairs.items():
        differs = ~col_(a).eqNullSafe(col_(b)) if null_safe else (col_(a) != col_(b))
        items.append(F.when(differs, F.lit(name)))
    return F.array_compact(F.array(*items))


def uuid_from_key(c: str | Column) -> Column:
    """Deterministic 8-4-4-4-12 id from the md5 of a key."""
    return F.regexp_replace(
        F.md5(col_(c).cast("string")),
        r"^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def short_id(*parts: str | Column) -> Column:
    """First 8 hex characters of the md5 of the joined parts."""
    return F.substring(F.md5(F.concat_ws("|", *[col_(p).cast("string") for p in parts])), 1, 8)


def normalise_id(c: str | Column) -> Column:
    """Canonical string id: trimmed lower-case."""
    return F.lower(F.trim(col_(c).cast("string")))


def split_title(title: str | Column, mime: str | Column, mime_map: Mapping = MIME_EXTENSIONS) -> tuple[Column, Column]:
    """(base name, extension) of a file title.

    Base = text before the last dot (whole title without a dot); extension =
    text after the last dot, else the MIME extension. NULL title -> NULL base,
    MIME extension.
    """
    t = col_(title)
    has_dot = F.instr(t, ".") > 0
    base = F.when(t.isNull(), F.lit(None).cast("string")).when(
        has_dot, F.regexp_extract(t, r"(?s)^(.*)\.[^.]*$", 1)
    ).otherwise(t)
    ext = F.when(has_dot, F.substring_index(t, ".", -1)).otherwise(lookup(mime_map, mime))
    return base, ext


def split_list(c: str | Column, sep: str = ",") -> Column:
    """Delimited string -> trimmed array, empty pieces dropped; NULL/'' -> []. ``sep`` is taken literally."""
    parts = F.transform(F.split(F.coalesce(col_(c), F.lit("")), rf"\Q{sep}\E"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def wide_to_array(*cols: str | Column) -> Column:
    """Wide columns -> array without NULL / empty values."""
    return F.filter(F.array(*[col_(c) for c in cols]), lambda x: x.isNotNull() & (x != F.lit("")))


def sorted_join(arr: str | Column, sep: str = ",") -> Column:
    return F.array_join(F.sort_array(col_(arr)), sep)


def fmt_ts(c: str | Column) -> Column:
    return F.date_format(col_(c), TS_FORMAT)


_OPS = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def compare(c: str | Column, op: str, value) -> Column:
    """Comparison whose operator is a parameter (e.g. keep zero vs non-zero balances)."""
    if op not in _OPS:
        raise ValueError(f"unsupported operator {op!r}")
    return _OPS[op](col_(c), F.lit(value))


UUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def parse_prefixed_uuid(c: str | Column, prefix: str) -> tuple[Column, Column]:
    """(status, uuid) for ids of the form ``<prefix><uuid>``.

    status: 'bad_format' (prefix missing), 'bad_uuid' (not 8-4-4-4-12 hex) or
    'ok'; uuid is the lower-case id when ok.
    """
    t = F.trim(col_(c))
    rest = F.substring(t, F.lit(len(prefix) + 1), F.length(t))
    has_prefix = t.startswith(prefix)
    valid = rest.rlike(UUID_RE)
    status = F.when(~has_prefix, "bad_format").when(~valid, "bad_uuid").otherwise("ok")
    return status, F.when(has_prefix & valid, F.lower(rest))
