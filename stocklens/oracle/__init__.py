"""The same questions as plain SQL, for checking results with another engine."""
