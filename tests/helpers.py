"""Small helpers the tests share."""

from __future__ import annotations

import contextlib
import io
import re


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def exchanges(df) -> int:
    """Exchange nodes in the plan's tree."""
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(r"Exchange \(\d+\)", tree))
