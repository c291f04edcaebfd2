"""Column-level helpers: enumerated domains, array ordering, statement time."""
