"""Column expressions: Column in, Column out, no Python on rows except entity decoding."""
