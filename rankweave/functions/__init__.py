"""Column expressions and the small Arrow kernels."""
