"""What several test modules share."""

from __future__ import annotations

import contextlib
import io

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
