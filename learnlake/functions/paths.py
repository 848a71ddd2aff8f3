"""Reading values out of VARIANT documents by dotted path.

A path is ``a.b.c``; a name with dots or punctuation is back-quoted and ``[n]`` picks a list element:
``statement.result.extensions.`http://x.y`.response``, ``context.parent[0].id``. A missing name, an index past the
end, or a JSON null anywhere on the way gives NULL.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"`([^`]+)`|\[(\d+)\]|([^.`\[\]]+)")


def json_path(path: str) -> str:
    """``a.`b.c`[0]`` -> ``$["a"]["b.c"][0]``; an empty path is the whole document."""
    steps = []
    for quoted, index, name in _STEP.findall(path):
        steps.append(f"[{index}]" if index else f'["{quoted or name}"]')
    return "$" + "".join(steps)


def column_name(path: str) -> str:
    """A flat column name for a path: runs of punctuation become ``_``."""
    return re.sub(r"[^0-9A-Za-z]+", "_", path).strip("_") or "document"


def at(doc: Column | str, path: str, dtype: str = "string") -> Column:
    """The value at ``path`` as ``dtype``; NULL when absent or not convertible."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, json_path(path), dtype)


def present(doc: Column | str, path: str) -> Column:
    """The path exists, even if its value is a JSON null."""
    return at(doc, path, "variant").isNotNull()


def not_null(doc: Column | str, path: str) -> Column:
    """The path exists and its value is not a JSON null."""
    value = at(doc, path, "variant")
    return value.isNotNull() & ~F.is_variant_null(value)


def at_or(doc: Column | str, path: str, default: str) -> Column:
    """The value at ``path``; ``default`` only when the path is absent (a JSON null stays NULL)."""
    return F.when(present(doc, path), at(doc, path)).otherwise(F.lit(default))


def project(doc: Column | str, mapping: Mapping[str, str | tuple[str, str] | Column]) -> list[Column]:
    """Select-list for ``{column: path | (path, type) | Column}``."""
    out = []
    for name, source in mapping.items():
        if isinstance(source, Column):
            value = source
        elif isinstance(source, tuple):
            value = at(doc, *source)
        else:
            value = at(doc, source)
        out.append(value.alias(name))
    return out
