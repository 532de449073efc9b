"""Operators on DataFrames: audit, changes, grid, joins, coverage, population, risk, costs, recommendations."""
