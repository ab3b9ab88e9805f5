"""Inputs shaped from the given tables, the registered queries and the stage flow."""
