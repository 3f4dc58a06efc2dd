"""Column functions over text, signals and vectors, and the plug points for models."""
