"""Where rows come from: tables, files, the catalog, number and calendar series, message feeds."""
