"""Column functions: text, labels, codes and links."""
