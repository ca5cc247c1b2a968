"""Operators: range query, joins, heat map, hull, pairs, union, stats."""
