"""Column functions: text, vectors, class labels and identifiers."""
