"""Named reports: each function returns ``{result name: DataFrame}``."""
