"""Table functions: DataFrame in, DataFrame out."""
