"""Column expressions; none of them runs Python on the executors."""
