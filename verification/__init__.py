"""Queries over the driver tables, each through a package operator, with SQL
that computes the same rows independently."""
