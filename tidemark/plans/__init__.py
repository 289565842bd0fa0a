"""Jobs: operators bound to the tables of a lake."""
