"""Table writes: appends, replacements, versioned refreshes, JSON and JDBC."""
