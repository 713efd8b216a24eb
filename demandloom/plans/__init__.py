"""Complete runs composed from the operators."""
