"""Column functions: strict and loose JSON, loose and strict casts."""
