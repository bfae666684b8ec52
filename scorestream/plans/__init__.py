"""Training and evaluation jobs put together from the operators."""
