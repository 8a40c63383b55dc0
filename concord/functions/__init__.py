"""Column functions: text, places, contacts, categories, similarity. All native expressions unless said otherwise."""
