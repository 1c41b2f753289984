"""Training-data operators: packing, scans, quality rules, search, language ID, mixing, joins, dedup and archives."""
