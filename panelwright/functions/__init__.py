"""Column-level building blocks: cleaning, tiers, labels, reason codes, actions."""
