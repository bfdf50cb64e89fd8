"""Column helpers for document-style predicates and transforms.

Every helper returns a built-in Catalyst expression, so it stays inside
whole-stage code generation; none goes through Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_element(arr: Column | str, value) -> Column:
    """Array field equals a scalar, i.e. the array contains it."""
    return F.array_contains(_c(arr), F.lit(value))


def any_element_in(arr: Column | str, values: Iterable) -> Column:
    """Some element of the array is in the list (elemMatch with $in).

    A null array, or an array whose only overlap would be null, gives null,
    which no filter keeps.
    """
    lits = [F.lit(v) for v in values]
    if not lits:
        return F.lit(False)
    return F.arrays_overlap(_c(arr), F.array(*lits))


def in_list(c: Column | str, values: Iterable) -> Column:
    """P10: scalar membership in a literal list; null gives null, which no
    filter keeps.  Left bare so that the scan can evaluate it."""
    return _c(c).isin(list(values))


def greater(c: Column | str, v) -> Column:
    """Null never matches (NaN was made null at ingest, D1)."""
    return _c(c) > F.lit(v)


def less(c: Column | str, v) -> Column:
    """Null never matches."""
    return _c(c) < F.lit(v)


def not_nan(c: Column | str) -> Column:
    """Keep numbers, drop NaN and null."""
    return _c(c).isNotNull() & ~F.isnan(_c(c))


def map_has_key(m: Column | str, key: str) -> Column:
    """The map has the key ($exists on a nested path)."""
    return F.map_contains_key(_c(m), F.lit(key))


def map_value(m: Column | str, key: str) -> Column:
    """nested path into a map; null when the key is missing."""
    return F.try_element_at(_c(m), F.lit(key))


def map_value_set(m: Column | str, key: str) -> Column:
    """P14, intended reading (D9): the key is present with a value that is
    neither null nor zero."""
    v = map_value(m, key)
    return map_has_key(m, key) & v.isNotNull() & (v != F.lit(0.0))


def nonzero_entries(m: Column | str) -> Column:
    """F11 over a map: keep entries whose value is neither null nor 0."""
    return F.map_filter(_c(m), lambda _k, v: v.isNotNull() & (v != F.lit(0.0)))


def full_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """'first last'; null when either part is null (concat, not concat_ws)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def sorted_text(arr: Column | str, sep: str = ",") -> Column:
    """Stable text form of an array: elements sorted, joined by ``sep``.

    Used for comparison with other engines; an empty array gives ''.
    """
    return F.array_join(F.sort_array(_c(arr)).cast("array<string>"), sep)


def map_text(m: Column | str, digits: int = 6) -> Column:
    """Stable text form of a string->double map: 'k:v' pairs sorted by key."""
    pairs = F.transform(
        F.array_sort(F.map_entries(_c(m))),
        lambda e: F.concat(e["key"], F.lit(":"),
                           F.coalesce(fixed_text(e["value"], digits), F.lit("null"))),
    )
    return F.array_join(pairs, ",")


def split_trim(text: Column | str, sep: str = ",") -> Column:
    """split a delimited list and strip white space, then single quotes."""
    return F.transform(
        F.split(_c(text), sep),
        lambda p: F.regexp_replace(F.regexp_replace(p, r"^\s+|\s+$", ""), r"^'+|'+$", ""),
    )


def split_trim_py(text: str, sep: str = ",") -> list[str]:
    """F19 for a caller-supplied argument (a parameter, not data)."""
    return [p.strip().strip("'") for p in text.split(sep)]


def distinct_parts(text: Column | str, sep: str = ",") -> Column:
    """number of distinct parts of a delimited text."""
    return F.size(F.array_distinct(F.split(_c(text), sep)))


def percent_label(x: Column | str, digits: int = 1) -> Column:
    """fixed-decimal percent label, e.g. 12.5%."""
    return F.concat(fixed_text(x, digits), F.lit("%"))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 6) -> Column:
    """Round on the binary value, half up: floor(x * 10^d + 0.5) / 10^d.

    Written with plain arithmetic so any engine evaluating the same formula
    gets the same double (``round`` differs across engines on decimal ties).
    Values too large to have that many digits, infinities and NaN stay as they
    are.
    """
    scale = float(10 ** digits)
    x = _c(c)
    return (F.when(F.abs(x) < F.lit(2.0 ** 52 / scale), F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale))
            .otherwise(x))


def fixed_text(c: Column | str, digits: int = 6) -> Column:
    """fixed-decimal text of a rounded value (no formatter tie rules)."""
    return F.format_string(f"%.{digits}f", round_half_up(c, digits))


# -- documents without a fixed schema (VARIANT) ----------------------------------

def document(text: Column | str) -> Column:
    """A JSON text as a VARIANT; null when it is no JSON."""
    return F.try_parse_json(_c(text))


def field_exists(doc: Column | str, path: str) -> Column:
    """The document has the field, be it null ($exists: true)."""
    return F.try_variant_get(_c(doc), path, "variant").isNotNull()


def field_is_null(doc: Column | str, path: str) -> Column:
    """The field is there and null."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(_c(doc), path, "variant")), F.lit(False))


def field_not_null(doc: Column | str, path: str) -> Column:
    """The field is there and not null ($ne: null)."""
    return field_exists(doc, path) & ~field_is_null(doc, path)


def field_value(doc: Column | str, path: str, kind: str) -> Column:
    """F17 into a document: the value as ``kind``; null when missing, null, or of another kind."""
    return F.try_variant_get(_c(doc), path, kind)
