"""Reading, writing, loading, and the season tables derived from the test tables."""
