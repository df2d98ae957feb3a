"""Part of terraframe: plans."""
