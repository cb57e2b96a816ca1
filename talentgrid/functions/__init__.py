"""Column -> Column building blocks; none of them needs a Python worker."""
