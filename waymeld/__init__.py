"""waymeld: a Spark-native engine for reconciling registers, feeds and text corpora."""
