"""The text of a plan, for tests of plans."""

import contextlib
import io


def explained(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
