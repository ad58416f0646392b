"""The same operators on an unbounded Bronze table."""
