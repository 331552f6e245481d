"""Where rows come from: topic messages, layer files, shared tables."""
