"""User-level functions: scalars, governed reads and the parameterised query tools."""
