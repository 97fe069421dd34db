"""Column functions and fixed code lists."""
