"""DataFrame -> DataFrame operators: quality rules, projections, dedup,
merge, watermarks, ranking, joins, and the gold dimensions, fact and KPIs."""
