"""Sources: event messages, mapping files, file listings, vendor CSV files."""
