"""Where data comes from: SQL results, local rows and frames, catalog tables."""
