"""Order-free comparison of two result sets."""

import math


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(left_columns, left, right_columns, right):
    assert sorted(left_columns) == sorted(right_columns)
    assert rows_of(left_columns, left) == rows_of(right_columns, right)
