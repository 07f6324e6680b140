"""Graph, text, trend and ranking analytics as PySpark DataFrame functions."""
