"""Column expressions: exact money and ratios, layout-independent hashed randomness."""
