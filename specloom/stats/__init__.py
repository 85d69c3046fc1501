"""Statistics: Spark reduces the rows, the driver finishes tables of bounded size."""
