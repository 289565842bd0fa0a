"""Write modes: interval replacement, upserts, logs, archives and exports."""
