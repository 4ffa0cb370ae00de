"""Table-level operators: DataFrame in, DataFrame out, keys and attributes as parameters."""
