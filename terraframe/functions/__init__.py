"""Part of terraframe: functions."""
