"""DataFrame transforms and data-quality checks."""
