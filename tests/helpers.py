"""Small helpers shared by the tests."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime, timedelta

T0 = datetime(2024, 3, 1, 12, 0, 0)


def at(**delta) -> datetime:
    return T0 + timedelta(**delta)


def rows(df, *cols):
    """Sorted tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df, executed: bool = False) -> str:
    if executed:
        df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = out.getvalue()
    return text.split("== Initial Plan ==")[0] if executed else text
