"""Column functions for reading JSON under strict typing."""
