"""Payments tables derived from the driver's test tables, and the query registry that runs over them."""
