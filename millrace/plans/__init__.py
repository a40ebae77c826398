"""Multi-step plans shared by operators: written intermediates, distributed numbering, interval merging."""
