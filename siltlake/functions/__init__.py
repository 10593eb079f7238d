"""Column functions: casts, classes, keys and exact sums."""
