"""Identity-resolution jobs as PySpark DataFrame plans."""
