"""Helpers of the tests; ``conftest`` holds only fixtures, as a second module of that name would hide them."""

TINY = "/root/testdata/sf0.001"


def as_dicts(df, *keys):
    """Rows as dictionaries, sorted by the given columns."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: [str(r[k]) for k in keys]) if keys else rows
