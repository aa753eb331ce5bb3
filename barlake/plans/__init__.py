"""Jobs composed of the operators."""
