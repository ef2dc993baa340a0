"""Column expressions: everything here returns a ``Column``."""
