"""DataFrame operators. Intervals, instants and thresholds are parameters.

All are lazy and pure, except compaction and file retention, which act on files.
"""
