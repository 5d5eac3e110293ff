"""End-to-end plans: fixture mapping, daily run, backfill, load, gates."""
