"""Helpers of the engine's tests; a name of its own, so that no other folder's module hides it."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df):
    """Collected rows as plain tuples, sorted for order-free comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
