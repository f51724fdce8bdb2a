"""waymeld plans."""
