"""waymeld operators."""
