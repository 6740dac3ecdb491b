"""Column functions: identifiers, formatting, arrays and statistics."""
