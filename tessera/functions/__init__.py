"""Column-to-Column helpers: pure Catalyst expressions, no Python at run time."""
