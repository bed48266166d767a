"""Where raw rows come from and where snapshots go."""
