"""Reading and writing memory tables."""
