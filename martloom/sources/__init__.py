"""Where rows come from: landing files, JDBC, and the sample tables."""
