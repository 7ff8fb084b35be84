"""Column-level helpers: exact money arithmetic, date bands, scalar rules."""
