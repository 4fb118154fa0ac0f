"""Evaluate costly expressions once per row."""

from pyspark.sql import Column, functions as F


def once(**columns: Column) -> Column:
    """The given columns as a generator of one row, for use in ``select``.

    The optimizer pushes a filter below the projection that makes its column and
    so repeats the column's expression, once per mention. It cannot do that
    through a generator. Generated code keeps the row in local variables.
    """
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
