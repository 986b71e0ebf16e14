"""Part of corvina; see the README."""
