"""Column expressions and image kernels."""
