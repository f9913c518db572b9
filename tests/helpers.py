"""Helpers of the tests."""

import contextlib
import io

SF = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()),
                  key=lambda t: tuple((v is None, str(type(v)), v) for v in t))


def plan_of(df) -> str:
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
