"""Measures of a classifier on held-out rows."""


def auc(scores, labels):
    """The share of (1, 0) pairs that are in order; ties count half."""
    ones = sorted(s for s, y in zip(scores, labels) if y == 1)
    zeros = sorted(s for s, y in zip(scores, labels) if y == 0)
    from bisect import bisect_left, bisect_right
    return sum((bisect_left(zeros, s) + bisect_right(zeros, s)) / 2 for s in ones) / (len(ones) * len(zeros))
