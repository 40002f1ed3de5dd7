"""Paper sources, acquisition plans, sinks and replaceable backends."""
