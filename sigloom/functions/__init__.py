"""Scalar and array kernels, as column expressions where those suffice."""
