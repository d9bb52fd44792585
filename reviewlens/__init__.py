"""reviewlens: fake-review analytics as PySpark DataFrame jobs."""
