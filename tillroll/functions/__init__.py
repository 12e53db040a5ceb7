"""Column functions and small aggregate building blocks."""
