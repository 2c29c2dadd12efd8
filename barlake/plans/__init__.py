"""Query plans: the harness registry, the SQL oracle texts and the full run."""
