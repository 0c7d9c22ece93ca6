"""Where rows go: lake tables and relational targets."""
