"""Column functions: field types and geometry."""
