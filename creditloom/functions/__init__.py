"""Column expressions: everything here maps ``Column`` to ``Column``."""
