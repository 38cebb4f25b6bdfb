"""jobtide.plans."""
