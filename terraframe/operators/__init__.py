"""Part of terraframe: operators."""
