"""DataFrame -> DataFrame operators (cleaning, ranking, explode, joins, checks)."""
