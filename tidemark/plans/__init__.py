"""Bindings of tables to the operators, and the registered queries."""
