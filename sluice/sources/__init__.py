"""Sources: delimited feed scans, derived feeds, optional JDBC sink options."""
