"""JSON property extraction for the property pivot."""

from __future__ import annotations

def json_property_sql(json_col: str, name: str) -> str:
    """SQL text: value of top-level property ``name`` (case sensitive; spaces and
    dots allowed) as a string with JSON quotes removed."""
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"replace(get_json_object(`{json_col}`, '$[\\'{escaped}\\']'), '\"', '')"


def variant_property_sql(variant_col: str, name: str) -> str:
    """The same from a VARIANT column: the JSON text is parsed once for all properties.

    A number comes in its shortest form (``1.50`` as ``1.5``).  A name may hold one
    kind of quotation mark."""
    if "'" in name and '"' in name:
        raise ValueError(f"a property name with both kinds of quotation marks: {name}")
    mark = '"' if "'" in name else "'"
    path = f"$[{mark}{name}{mark}]".replace("\\", "\\\\").replace("'", "\\'")
    return f"replace(try_variant_get(`{variant_col}`, '{path}', 'string'), '\"', '')"
