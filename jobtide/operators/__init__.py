"""jobtide.operators."""
