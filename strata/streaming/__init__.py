"""The same loads driven by arriving files."""
