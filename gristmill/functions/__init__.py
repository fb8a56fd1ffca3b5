"""Column builders: every function returns an expression, never runs a job."""
