"""Column expressions (vector math, hash keys, feature names)."""
