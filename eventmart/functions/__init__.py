"""Column helpers: no Python runs per row here, everything is a Catalyst expression."""
