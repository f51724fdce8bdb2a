"""Readers: every function takes a session and paths that Spark can open, and returns a DataFrame."""
