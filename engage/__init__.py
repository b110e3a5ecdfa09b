"""Customer-contact and membership analytics as plain PySpark DataFrame functions."""
