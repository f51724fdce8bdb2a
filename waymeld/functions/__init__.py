"""waymeld functions."""
