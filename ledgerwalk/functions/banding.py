"""Discount banding (M3a; trap T2).

Bands are right-open: an exact zero rate is its own band, then (0, e1), [e1, e2),
[e2, e3), and everything else - including a NULL rate - falls in the last band.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# The published band edges.
DEFAULT_BAND_EDGES = (0.10, 0.20, 0.30)


def _pct(x: float) -> str:
    v = round(x * 100, 6)
    return str(int(v)) if v == int(v) else str(v)


def band_labels(edges=DEFAULT_BAND_EDGES) -> list[str]:
    """Labels for the zero band, the inner bands and the open top band."""
    pts = [_pct(e) for e in edges]
    labels = ["0%", f"1-{pts[0]}%"]
    labels += [f"{lo}-{hi}%" for lo, hi in zip(pts, pts[1:])]
    labels.append(f"{pts[-1]}%+")
    return labels


def band_columns(rate, edges=DEFAULT_BAND_EDGES) -> tuple[Column, Column]:
    """(label, rank) columns for a rate column."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    labels = band_labels(edges)
    label = F.when(rate == 0, F.lit(labels[0]))
    rank = F.when(rate == 0, F.lit(0))
    for i, e in enumerate(edges):
        label = label.when(rate < F.lit(Decimal(repr(e))), F.lit(labels[i + 1]))
        rank = rank.when(rate < F.lit(Decimal(repr(e))), F.lit(i + 1))
    label = label.otherwise(F.lit(labels[-1]))
    rank = rank.otherwise(F.lit(len(edges) + 1))
    return label, rank
