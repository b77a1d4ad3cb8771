"""WKB geometry → segments table, decoded in Arrow batches on executors.

Parsing bytes has no built-in Spark expression, so this is the one Python
step: each task decodes its batches of blobs into flat segment rows
(:mod:`sitewise.sources.wkb`); everything downstream (containment, nearest
border, lengths, areas, midpoints) is plain Spark on that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sitewise.sources import wkb


def wkb_parts(blob: bytes | None) -> list[list[tuple[float, float]]]:
    """Coordinate sequences of one WKB/EWKB/GeoPackage blob (empty → [])."""
    import numpy as np

    raw = np.frombuffer(bytes(blob or b""), np.uint8)
    d = wkb.decode(raw, np.array([0, len(raw)]))
    points = list(zip(d.x.tolist(), d.y.tolist(), strict=True))
    ends = np.cumsum(d.size).tolist()
    return [points[e - n:e] for e, n in zip(ends, d.size.tolist(), strict=True)]


def wkb_segments(df: DataFrame, id_col: str, wkb_col: str) -> DataFrame:
    """(id, part, seq, x1, y1, x2, y2) for every segment; a one-point part
    gives one zero-length segment so points and lines share the table."""
    return wkb.segments(df, id_col, wkb_col).drop("geom", "ring")
