"""Where rows come from: delimited files, and feeds derived from other tables."""
