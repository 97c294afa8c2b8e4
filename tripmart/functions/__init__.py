"""Column-level semantics: casts, wall-clock time, rounding, code names, labels."""
