"""Small functions on summary values."""
