"""jobtide.functions."""
