"""Operators for large training corpora; nothing else in the library depends on them."""
