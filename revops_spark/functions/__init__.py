"""Column-level helpers: scalar expressions (`exprs`) and statistics (`stats`)."""
