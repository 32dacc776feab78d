"""DataFrame operators: a fit step returns a small state, an apply step is a projection or filter."""
