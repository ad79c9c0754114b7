"""Plain SQL for every registered query, to compare results with."""
