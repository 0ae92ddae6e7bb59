"""The jobs and reports a user calls."""
