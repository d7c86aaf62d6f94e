"""Table-level operators: DataFrame in, DataFrame out, keys as arguments."""
