"""Column-expression helpers shared by the operators."""
