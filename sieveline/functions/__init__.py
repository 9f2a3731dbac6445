"""Column expressions: normalization, features, scalars."""
