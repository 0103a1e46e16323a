"""Column-level helpers: hash uniforms, clipping, distribution functions, ranks."""
