"""Column functions: missing values, clocks, text and path helpers."""
