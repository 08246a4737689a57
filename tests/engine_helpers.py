"""Helpers of the engine's tests (a name of its own, so that no other test folder can shadow it)."""

from __future__ import annotations

import contextlib
import io

SF_SMALL = "/root/testdata/sf0.001"


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
