"""jobtide.streaming."""
