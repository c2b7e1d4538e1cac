"""Where rows come from: the bus, directories, API listings, landed records, tables."""
