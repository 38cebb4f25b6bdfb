"""jobtide.sources."""
