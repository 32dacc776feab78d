"""Column-level helpers; every one returns a native Column expression."""
