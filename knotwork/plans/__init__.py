"""Compositions of operators, and the queries made of them."""
