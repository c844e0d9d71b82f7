"""End-to-end jobs (prepare, train, score) and plan helpers (guarded broadcast, plan checks)."""
