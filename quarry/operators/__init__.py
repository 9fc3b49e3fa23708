"""DataFrame-in, DataFrame-out operators, one module per area of SURVEY §2."""
