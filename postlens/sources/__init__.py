"""Where rows come from: post schemas, dictionaries, topics and archives."""
