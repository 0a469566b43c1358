"""Where rows come from: tables, files, topics and synthetic generators."""
