"""Part of terraframe: streaming."""
