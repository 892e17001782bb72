"""Column functions and the NumPy kernels that run inside tasks."""
