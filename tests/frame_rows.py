"""Rows of a frame in a form that tests compare, and the folder of the smallest tables."""

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
