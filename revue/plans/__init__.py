"""Query catalogue and oracle SQL."""
