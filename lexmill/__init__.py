"""Text-corpus analytics as Spark DataFrame functions."""
