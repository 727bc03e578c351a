"""Registered queries and their SQL twins, one module per area of the library."""
