"""Writing results: appends, replace, dated report export and the incremental key load."""
