"""Ready-made jobs put together from the operators."""
