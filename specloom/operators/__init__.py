"""DataFrame -> DataFrame operators. Column names are arguments throughout."""
