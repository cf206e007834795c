"""Dataset operators: rows, routing, grouping, joins, threads and data-quality channels."""
