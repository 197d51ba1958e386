"""The queries once more as plain SQL, written apart from the Spark code, to check it."""
