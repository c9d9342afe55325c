"""DataFrame-in, DataFrame-out operators of the screening."""
