"""Plans: multi-step jobs that write (loads, keyed merges, snapshots, audit)."""
