"""Complete analyses over the star tables, built from the operators."""
