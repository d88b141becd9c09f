"""Small helpers of the tests (a module of its own: there is more than one conftest)."""

import datetime as dt


def rows(df, *order):
    """Collected rows as tuples, sorted (by ``order`` columns when given)."""
    if order:
        df = df.orderBy(*order)
        return [tuple(r) for r in df.collect()]
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


D = dt.date
T = dt.datetime
