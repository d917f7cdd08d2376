"""Column-expression helpers and fixed configuration values."""
