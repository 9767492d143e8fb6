"""Where rows come from: the monthly panel, catalog tables and raw files."""
