"""Column names of operators that work on tables with any columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many leading underscores more as no column has."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns but doc_id and text renamed by position, so that none meets an
    operator's own; ``toDF`` with the old names takes them back."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(docs.columns)))
