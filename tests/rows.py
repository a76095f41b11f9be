"""Rows of a table as tuples, for comparing."""


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
