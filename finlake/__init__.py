"""finlake: retail-banking analytics as plain PySpark DataFrame operators."""
