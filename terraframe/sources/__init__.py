"""Part of terraframe: sources."""
