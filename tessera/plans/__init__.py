"""Query plans: each registered key composes library operators over the driver tables
and carries an independent SQL statement that computes the same result."""
