"""Helpers of the tests; a plain module, because two folders have a conftest."""


def rows(df):
    """Rows as sorted tuples, for comparing small results."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
