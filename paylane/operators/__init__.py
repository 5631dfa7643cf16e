"""DataFrame-to-DataFrame operators: lazy, distributed, nothing collected."""
