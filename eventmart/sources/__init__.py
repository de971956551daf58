"""Where rows come from: topics (streams and their lake mirrors) and views over the test tables."""
