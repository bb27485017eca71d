"""Collecting frames in tests."""


def rows(df, *order):
    """Collect as a list of dicts, sorted by ``order`` columns."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is not None, r[c]) for c in order))
    return out
