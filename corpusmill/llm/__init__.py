"""Training-data operators for large text corpora; nothing else in the library imports this subpackage."""
