"""Bound plans: the ten analytics over weather readings, the same analytics
bound to the driver's ``events`` table, the normalisation job and the
serving queries."""
