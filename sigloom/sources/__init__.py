"""Views over stored tables, and readers of binary formats."""
