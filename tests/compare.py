from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    clean = [
        tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r)
        for r in pdf[cols].itertuples(index=False)
    ]
    return sorted(clean, key=repr)
