"""Column expressions: no actions, no Python on executors."""
