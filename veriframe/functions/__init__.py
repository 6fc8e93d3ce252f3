"""Column functions and the skew-safe building blocks."""
