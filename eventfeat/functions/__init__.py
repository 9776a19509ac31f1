"""Column-expression functions (no UDFs): code parsers, clock algebra, numeric helpers."""
