"""Column functions: scalars, arrays, and numeric kernels for signals."""
