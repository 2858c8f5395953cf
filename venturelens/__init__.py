"""Company-intelligence jobs as PySpark DataFrame code."""
