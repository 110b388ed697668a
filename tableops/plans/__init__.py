"""Work made of several statements: scripts and daily backfills."""
