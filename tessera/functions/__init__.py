"""See the package documentation."""
